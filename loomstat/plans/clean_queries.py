"""Attribute-map cleaning and encoding queries. Domains are narrower than the
data, so that outliers and missing values exist."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import clean
from loomstat.operators.clean import Attr
from loomstat.operators.quantile import column_medians
from loomstat.plans.catalog import query, rounded, table

LINE_MAP = {
    "l_orderkey": Attr("id"),
    "l_extendedprice": Attr("interval", (1000.0, 100000.0)),
    "l_quantity": Attr("interval", (5.0, 45.0)),
    "l_discount": Attr("interval", (0.01, 0.09)),
    "l_tax": Attr("interval", (0.0, 0.07)),
    "l_returnflag": Attr("nominal", ("A", "N")),
    "l_linestatus": Attr("binary", ("O", "F")),
    "l_shipdate": Attr("ignore"),
}
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
TARGET = "l_extendedprice"

CLEANED_SQL = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN l_extendedprice BETWEEN 1000 AND 100000 THEN l_extendedprice END AS l_extendedprice,
           CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS l_quantity,
           CASE WHEN l_discount BETWEEN 0.01 AND 0.09 THEN l_discount END AS l_discount,
           CASE WHEN l_tax BETWEEN 0 AND 0.07 THEN l_tax END AS l_tax,
           CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS l_returnflag,
           CASE WHEN l_linestatus IN ('O', 'F') THEN l_linestatus END AS l_linestatus
    FROM lineitem"""


def _lines(spark, d):
    return table(spark, d, "lineitem")


@query(
    """SELECT 'l_orderkey' AS attribute, 'id' AS role, count(*) FILTER (WHERE l_orderkey IS NULL) AS missing, CAST(0 AS BIGINT) AS outliers FROM lineitem
       UNION ALL SELECT 'l_extendedprice', 'interval', count(*) FILTER (WHERE l_extendedprice IS NULL), count(*) FILTER (WHERE l_extendedprice NOT BETWEEN 1000 AND 100000) FROM lineitem
       UNION ALL SELECT 'l_quantity', 'interval', count(*) FILTER (WHERE l_quantity IS NULL), count(*) FILTER (WHERE l_quantity NOT BETWEEN 5 AND 45) FROM lineitem
       UNION ALL SELECT 'l_discount', 'interval', count(*) FILTER (WHERE l_discount IS NULL), count(*) FILTER (WHERE l_discount NOT BETWEEN 0.01 AND 0.09) FROM lineitem
       UNION ALL SELECT 'l_tax', 'interval', count(*) FILTER (WHERE l_tax IS NULL), count(*) FILTER (WHERE l_tax NOT BETWEEN 0 AND 0.07) FROM lineitem
       UNION ALL SELECT 'l_returnflag', 'nominal', count(*) FILTER (WHERE l_returnflag IS NULL), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
       UNION ALL SELECT 'l_linestatus', 'binary', count(*) FILTER (WHERE l_linestatus IS NULL), count(*) FILTER (WHERE l_linestatus NOT IN ('O', 'F')) FROM lineitem
       UNION ALL SELECT 'l_shipdate', 'ignore', count(*) FILTER (WHERE l_shipdate IS NULL), CAST(0 AS BIGINT) FROM lineitem"""
)
def p6_attribute_audit(spark, d):
    return clean.attribute_audit(_lines(spark, d), LINE_MAP)


@query(
    """SELECT * FROM (VALUES ('id', CAST(1 AS BIGINT)), ('interval', CAST(4 AS BIGINT)), ('nominal', CAST(1 AS BIGINT)),
                             ('binary', CAST(1 AS BIGINT)), ('ignore', CAST(1 AS BIGINT))) AS t(role, n_attributes)"""
)
def p6_role_counts(spark, d):
    return clean.role_counts(clean.attribute_audit(_lines(spark, d), LINE_MAP))


@query(
    """SELECT 'id' AS role, CAST(1 AS BIGINT) AS n_attributes, CAST(count(*) - count(l_orderkey) AS BIGINT) AS missing, CAST(0 AS BIGINT) AS outliers FROM lineitem
       UNION ALL SELECT 'interval', 4, CAST(4 * count(*) - count(l_extendedprice) - count(l_quantity) - count(l_discount) - count(l_tax) AS BIGINT),
           CAST(count(*) FILTER (WHERE l_extendedprice NOT BETWEEN 1000 AND 100000) + count(*) FILTER (WHERE l_quantity NOT BETWEEN 5 AND 45)
               + count(*) FILTER (WHERE l_discount NOT BETWEEN 0.01 AND 0.09) + count(*) FILTER (WHERE l_tax NOT BETWEEN 0 AND 0.07) AS BIGINT) FROM lineitem
       UNION ALL SELECT 'nominal', 1, CAST(count(*) - count(l_returnflag) AS BIGINT), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
       UNION ALL SELECT 'binary', 1, CAST(count(*) - count(l_linestatus) AS BIGINT), count(*) FILTER (WHERE l_linestatus NOT IN ('O', 'F')) FROM lineitem
       UNION ALL SELECT 'ignore', 1, CAST(count(*) - count(l_shipdate) AS BIGINT), CAST(0 AS BIGINT) FROM lineitem"""
)
def p6_role_figures(spark, d):
    return clean.role_figures(clean.attribute_audit(_lines(spark, d), LINE_MAP))


@query(CLEANED_SQL)
def c1_replace_outliers(spark, d):
    columns = [*KEYS, "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return clean.replace_outliers(_lines(spark, d), LINE_MAP).select(*columns)


def _cleaned(spark, d, **options):
    rows = _lines(spark, d)
    return clean.TableCleaner(LINE_MAP, no_impute=[TARGET], keep=KEYS, **options).fit_transform(rows)


@query(
    f"""WITH c AS ({CLEANED_SQL})
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM c)), 6) AS l_quantity,
               round(coalesce(l_discount, (SELECT avg(l_discount) FROM c)), 6) AS l_discount
        FROM c WHERE l_extendedprice IS NOT NULL"""
)
def c2_impute_interval(spark, d):
    return rounded(_cleaned(spark, d).select(*KEYS, "l_quantity", "l_discount"))


@query(
    f"""WITH c AS ({CLEANED_SQL})
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               round(coalesce(l_quantity, (SELECT median(l_quantity) FROM c)), 6) AS l_quantity,
               round(coalesce(l_discount, (SELECT median(l_discount) FROM c)), 6) AS l_discount,
               round(coalesce(l_tax, (SELECT median(l_tax) FROM c)), 6) AS l_tax
        FROM c WHERE l_extendedprice IS NOT NULL"""
)
def c2_impute_median(spark, d):
    return rounded(_cleaned(spark, d, interval_fill="median").select(*KEYS, "l_quantity", "l_discount", "l_tax"))


@query(
    """WITH i AS (
            SELECT CASE WHEN l_extendedprice BETWEEN 1000 AND 100000 THEN l_extendedprice * (1 - l_discount) END AS net,
                   l_extendedprice, l_quantity, l_discount, l_tax FROM lineitem)
        SELECT 'net' AS attribute, round(median(net), 6) AS median FROM i
        UNION ALL SELECT 'l_extendedprice', round(median(l_extendedprice), 6) FROM i
        UNION ALL SELECT 'l_quantity', round(median(l_quantity), 6) FROM i
        UNION ALL SELECT 'l_discount', round(median(l_discount), 6) FROM i
        UNION ALL SELECT 'l_tax', round(median(l_tax), 6) FROM i"""
)
def c2_exact_medians(spark, d):
    """Medians of many columns and one expression, none of them approximate."""
    net = F.when(F.col(TARGET).between(1000, 100000), F.col(TARGET) * (1 - F.col("l_discount")))
    found = column_medians(_lines(spark, d), {"net": net, **{c: F.col(c) for c in (TARGET, "l_quantity", "l_discount", "l_tax")}})
    return rounded(spark.createDataFrame(sorted(found.items()), "attribute string, median double"))


@query(
    f"""WITH c AS ({CLEANED_SQL}),
        m AS (SELECT l_returnflag AS v FROM c WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CAST(coalesce(l_returnflag, (SELECT v FROM m)) = 'A' AS DOUBLE) AS is_a
        FROM c WHERE l_extendedprice IS NOT NULL"""
)
def c3_impute_mode(spark, d):
    return _cleaned(spark, d).select(*KEYS, F.col("`l_returnflag0:A`").alias("is_a"))


@query(
    f"""WITH c AS ({CLEANED_SQL})
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM c WHERE l_extendedprice IS NOT NULL"""
)
def c4_no_impute(spark, d):
    """The target is neither filled nor scaled; rows without it are dropped."""
    return _cleaned(spark, d, interval_scale="std").select(*KEYS, TARGET)


PART_MAP = {
    "p_partkey": Attr("id"),
    "p_type": Attr("nominal", ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")),
    "p_size": Attr("nominal", tuple(range(1, 51))),
    "p_name": Attr("text"),
}


@query(
    """SELECT p_partkey, CAST(p_type = 'ECONOMY' AS DOUBLE) AS t0, CAST(p_type = 'LARGE' AS DOUBLE) AS t1,
              CAST(p_type = 'STANDARD' AS DOUBLE) AS t5, CAST(p_size = 7 AS DOUBLE) AS size7 FROM part"""
)
def c5_one_hot(spark, d):
    """All levels kept: text levels are numbered, numeric levels are not."""
    out = clean.TableCleaner(PART_MAP, drop=False, keep=["p_partkey"]).fit_transform(table(spark, d, "part"))
    return out.select(
        "p_partkey",
        F.col("`p_type0:ECONOMY`").alias("t0"),
        F.col("`p_type1:LARGE`").alias("t1"),
        F.col("`p_type5:STANDARD`").alias("t5"),
        F.col("p_size7").alias("size7"),
    )


@query(
    f"""WITH c AS ({CLEANED_SQL}), m AS (SELECT avg(l_quantity) AS q, avg(l_tax) AS t FROM c),
        f AS (SELECT c.* EXCLUDE (l_quantity, l_tax), coalesce(l_quantity, q) AS l_quantity, coalesce(l_tax, t) AS l_tax FROM c, m),
        s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM f)
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round((l_quantity - mq) / sq, 6) + 0.0 AS l_quantity,
               round((l_tax - mt) / st, 6) + 0.0 AS l_tax
        FROM f, s WHERE l_extendedprice IS NOT NULL"""
)
def c6_scale_std(spark, d):
    return rounded(_cleaned(spark, d, interval_scale="std").select(*KEYS, "l_quantity", "l_tax"))


@query(
    f"""WITH c AS ({CLEANED_SQL})
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_linestatus = 'F' AS DOUBLE) AS l_linestatus
        FROM c WHERE l_extendedprice IS NOT NULL"""
)
def c7_encode_binary(spark, d):
    return _cleaned(spark, d).select(*KEYS, "l_linestatus")


@query(
    """SELECT column_name FROM (VALUES ('l_extendedprice'), ('l_quantity'), ('l_discount'), ('l_tax'),
       ('l_returnflag0:A'), ('l_linestatus')) AS t(column_name), (SELECT count(*) AS n FROM lineitem) WHERE n > 0"""
)
def c8_role_filter(spark, d):
    """Columns left after id, text and ignored attributes are gone, found on the fitted table."""
    out = clean.TableCleaner(LINE_MAP, no_impute=[TARGET]).fit_transform(_lines(spark, d))
    present = out.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(out.columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n")) for i, c in enumerate(out.columns)])
    return present.select(F.inline(cells)).filter("n > 0").select("column_name")


HASH_SQL = """((((l_orderkey * 1000003 + l_partkey * 8191 + l_suppkey * 64 + l_linenumber) % 1000000007) * 2654435761 + 7) % 2147483647) % 1000 < 700"""


def line_key():
    """One number per line item; collisions only put two rows on the same side of a split."""
    return F.col("l_orderkey") * 1000003 + F.col("l_partkey") * 8191 + F.col("l_suppkey") * 64 + F.col("l_linenumber")


@query(
    f"""WITH c AS ({CLEANED_SQL}), t AS (SELECT * FROM c WHERE {HASH_SQL}),
        m AS (SELECT avg(l_quantity) AS q FROM t)
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, round(coalesce(l_quantity, q), 6) AS l_quantity
        FROM c, m WHERE NOT ({HASH_SQL}) AND l_extendedprice IS NOT NULL"""
)
def c9_fit_train_apply_valid(spark, d):
    """Statistics learnt on the training rows, applied to the others."""
    from loomstat.operators.evaluate import split_train_valid

    rows = split_train_valid(_lines(spark, d), line_key(), seed=7)
    cleaner = clean.TableCleaner(LINE_MAP, no_impute=[TARGET], keep=KEYS)
    cleaner.fit(rows.filter("split = 'train'"))
    out = cleaner.transform(rows.filter("split = 'valid'"))
    return rounded(out.select(*KEYS, TARGET, "l_quantity"))
