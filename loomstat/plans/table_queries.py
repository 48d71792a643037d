"""Scans, sinks, profiling and projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import profile, reshape
from loomstat.plans.catalog import query, rounded, table
from loomstat.session import work_path
from loomstat.sources import tables

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string"
)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def s1_scan_table(spark, d):
    """Parquet scan with an explicit schema."""
    orders = tables.scan_table(spark, f"{d}/orders.parquet", ORDERS_SCHEMA)
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("SELECT event_type, user_id, value FROM events")
def s2_scan_headerless_csv(spark, d):
    """CSV without header, names supplied by the caller."""
    path = work_path(spark, "events-csv")
    tables.write_table(table(spark, d, "events").select("event_type", "user_id", "value"), path, "csv")
    return tables.scan_headerless_csv(spark, path, [("event_type", "string"), ("user_id", "bigint"), ("value", "double")])


@query(
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type"
)
def s3_scan_dir(spark, d):
    """One scan over the files of a folder that match prefix and suffix; files
    of another kind in the same folder are not read."""
    path = work_path(spark, "events-dir")
    events = table(spark, d, "events").select("event_type", "value")
    events.repartition(4).write.mode("append").csv(path)
    events.write.mode("append").json(path)
    found = tables.scan_dir(spark, path, "event_type string, value double", "part-", ".csv")
    out = found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rounded(out, 4)


@query(
    """SELECT CAST(hour(ts) AS INTEGER) AS airspeed, event_type AS kind,
              round(hour(ts) * CAST(1.9438 AS DOUBLE), 6) AS ktas, count(*) AS n, round(avg(value), 6) AS mean_value
       FROM events GROUP BY 1, 2, 3"""
)
def s4_file_attrs(spark, d):
    """Attributes read from the file path, and a unit conversion."""
    path = work_path(spark, "events-attrs")
    events = table(spark, d, "events").select(
        F.hour("ts").alias("speed"), F.col("event_type").alias("kind"), "value"
    )
    events.repartition("speed", "kind").write.partitionBy("speed", "kind").csv(path)
    found = tables.scan_dir(spark, path, "value double", suffix=".csv")
    attrs = tables.with_file_attrs(found, {"airspeed": (r"/speed=([^/]+)/", "int"), "kind": (r"/kind=([^/]+)/", "string")})
    out = tables.with_knots(attrs).groupBy("airspeed", "kind", "ktas").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")
    )
    return rounded(out)


@query("SELECT source, text FROM documents")
def s5_scan_columns(spark, d):
    return tables.scan_columns(spark, f"{d}/documents.parquet", ["source", "text"])


@query("SELECT c_custkey, c_mktsegment, c_acctbal, c_acctbal < 0 AS in_debt FROM customer")
def s6_save_load_stage(spark, d):
    """A scored table handed from one job to the next."""
    path = work_path(spark, "stage")
    scored = table(spark, d, "customer").select(
        "c_custkey", "c_mktsegment", "c_acctbal", (F.col("c_acctbal") < 0).alias("in_debt")
    )
    tables.save_stage(scored, path)
    return tables.load_stage(spark, path)


@query("SELECT p_partkey, p_brand, p_size FROM part")
def s7_write_table(spark, d):
    """Partitioned sink, read back."""
    path = work_path(spark, "parts")
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    tables.write_table(parts.repartition("p_brand"), path, partition_by=["p_brand"])
    return tables.scan_table(spark, path).select("p_partkey", F.col("p_brand").cast("string"), "p_size")


@query(
    """SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns, count(*) * 11 AS n_cells FROM lineitem"""
)
def p1_shape(spark, d):
    return profile.shape(table(spark, d, "lineitem"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def p1_head(spark, d):
    """First rows in key order: a report, hence the limit."""
    return profile.head(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 5)


@query("SELECT DISTINCT p_type FROM part")
def p2_levels(spark, d):
    return profile.levels(table(spark, d, "part"), "p_type")


@query(
    """SELECT min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max,
              min(l_extendedprice) AS l_extendedprice_min, max(l_extendedprice) AS l_extendedprice_max FROM lineitem"""
)
def p3_range_of(spark, d):
    return profile.range_of(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")


@query(
    """SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
              count(*) FILTER (WHERE l_quantity > 45) AS large,
              count(*) FILTER (WHERE l_discount BETWEEN 0.02 AND 0.05) AS discounted FROM lineitem"""
)
def p4_count_where(spark, d):
    return profile.count_where(
        table(spark, d, "lineitem"),
        returned=F.col("l_returnflag") == "R",
        large=F.col("l_quantity") > 45,
        discounted=F.col("l_discount").between(0.02, 0.05),
    )


@query(r"SELECT doc_id, source FROM documents WHERE regexp_matches(text, '\bthe\b')")
def p5_filter_word(spark, d):
    from loomstat.functions.words import contains_word

    return table(spark, d, "documents").filter(contains_word(F.col("text"), "the")).select("doc_id", "source")


@query("SELECT doc_id, source FROM documents WHERE contains(text, 'the')")
def p5_filter_substring(spark, d):
    return table(spark, d, "documents").filter(F.col("text").contains("the")).select("doc_id", "source")


@query(
    """SELECT CAST(3000 AS BIGINT) AS cap, max(length(text)) AS max_length,
              count(*) FILTER (WHERE length(text) >= 3000) AS n_at_cap, count(*) AS n_rows FROM documents"""
)
def p7_text_length_audit(spark, d):
    return profile.text_length_audit(table(spark, d, "documents"), "text", 3000)


@query("SELECT c_custkey AS customer, c_nationkey AS nation, c_mktsegment, 'retail' AS feed FROM customer")
def p8_project(spark, d):
    return profile.project(
        table(spark, d, "customer"), drop=["c_name", "c_acctbal"],
        rename={"c_custkey": "customer", "c_nationkey": "nation"}, literals={"feed": "retail"},
    )


@query("SELECT doc_id, lang FROM documents WHERE length(text) > 300")
def p9_filter_min_length(spark, d):
    return profile.filter_min_length(table(spark, d, "documents"), "text").select("doc_id", "lang")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def p10_filter_group(spark, d):
    return profile.filter_group(table(spark, d, "customer"), "c_mktsegment", "BUILDING").select("c_custkey", "c_acctbal")


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_quantity BETWEEN 5 AND 45 AND l_discount BETWEEN 0.01 AND 0.09"""
)
def p11_drop_incomplete(spark, d):
    from loomstat.operators.clean import Attr, replace_outliers

    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")
    amap = {"l_quantity": Attr("interval", (5.0, 45.0)), "l_discount": Attr("interval", (0.01, 0.09))}
    return profile.drop_incomplete(replace_outliers(rows, amap))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def p12_top_n(spark, d):
    return profile.top_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 10)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def p12_bottom_n(spark, d):
    return profile.bottom_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 10)


@query(
    """WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
       SELECT o_custkey, n, row_number() OVER (ORDER BY n DESC, o_custkey) <= 20 AS in_top FROM c"""
)
def p12_top_and_rest(spark, d):
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return profile.split_top(counts, "n", ["o_custkey"], 20)


@query(
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean_o_totalprice FROM orders
       GROUP BY 1 ORDER BY mean_o_totalprice DESC"""
)
def p12_sort_summary(spark, d):
    means = reshape.group_mean(table(spark, d, "orders"), ["o_orderpriority"], ["o_totalprice"])
    return rounded(profile.sort_by(means, "mean_o_totalprice", ["o_orderpriority"]), 4)
