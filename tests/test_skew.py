"""Hot keys: dedup and lookup joins spread their rows, and stay right."""

import pytest
from pyspark.sql import functions as F

from loomstat.operators import joins, reshape


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda table, rows=0: False)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_rows(spark, n=12_000):
    """Three tenths of the rows have one key, a tenth none."""
    kind = F.pmod(F.xxhash64("id"), F.lit(10))
    key = F.when(kind < 3, "hot").when(kind < 9, F.concat(F.lit("k"), (F.col("id") % 3000).cast("string")))
    return spark.range(n).repartition(6).select("id", key.alias("k"))


def lookup(spark):
    return spark.range(2500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("name"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1)], "name string, v long")
    )


@pytest.mark.parametrize("partitions", [8, 200])
@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_salted_join_equals_the_plain_one(spark, no_broadcast, partitions, how):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    big, table = hot_rows(spark), lookup(spark)
    got = joins.lookup_join(big, table, "k", how)
    want = big.join(table, big["k"] == table["name"], how).drop("name")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("partitions", [8, 200])
def test_hot_key_spreads_over_all_tasks(spark, no_broadcast, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    big = hot_rows(spark, 40_000)
    hot = dict(joins.hot_keys(big, "k", partitions))
    assert set(hot) == {"hot", None}
    assert hot["hot"] == pytest.approx(0.3 * partitions / joins.HOT_PART, rel=0.2)
    sizes = [r["count"] for r in joins.lookup_join(big, lookup(spark), "k").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 0.9 * partitions
    assert max(sizes) < 5 * 40_000 / partitions


def test_even_keys_get_no_salts(spark, no_broadcast):
    even = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    assert joins.hot_keys(even, "k", 8) == []
    assert joins.lookup_join(even, lookup(spark), "k").count() == 5000
    assert joins.lookup_join(even.limit(0), lookup(spark), "k").count() == 0


ORDERS = {"long": "id", "date": "date_add(date'2020-01-01', cast(id as int))", "timestamp": "timestamp_seconds(id * 1000)", "double": "id / 7D", "int": "cast(-id as int)"}


@pytest.mark.parametrize("kind", list(ORDERS))
def test_dedup_by_any_order(spark, kind):
    df = spark.range(300).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 17)) as k", f"if(id % 50 = 7, null, {ORDERS[kind]}) as o", "concat('text ', id) as text", "id")
    got = {r.k: r.id for r in reshape.dedup(df, ["k"], ["o"]).collect()}
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.o is not None, r.o if r.o is not None else 0)):
        want.setdefault(r.k, []).append(r)
    assert set(got) == set(want)
    for k, rows in want.items():
        assert got[k] in [r.id for r in rows if r.o == rows[0].o]


def test_dedup_extremes_ties_and_copies(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [("a", high, "x"), ("a", low, "y"), ("b", high, "z"), ("c", 5, "one"), ("c", 5, "two"), ("d", 1, "same"), ("d", 1, "same"), (None, 2, "n"), ("e", None, "p"), ("e", low, "q")]
    df = spark.createDataFrame(rows, "k string, o long, t string").repartition(4)
    got = sorted(((r.k, r.o, r.t) for r in reshape.dedup(df, ["k"], ["o"]).collect()), key=repr)
    assert len(got) == 6 and ("a", low, "y") in got and ("b", high, "z") in got and ("d", 1, "same") in got and (None, 2, "n") in got and ("e", None, "p") in got
    assert [r for r in got if r[0] == "c"] == [next(r for r in sorted(set(reshape.dedup(df, ["k"], ["o"]).where("k = 'c'").collect())))]


def test_dedup_never_meets_by_key_alone(spark, no_broadcast):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    df = spark.range(8000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as k", "repeat('t', 20) as t")
    out = reshape.dedup(df, ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 3 and sum("_name" in line for line in shuffles) == 2  # winners by key, then both sides by the full name
    assert out.count() == 5334
