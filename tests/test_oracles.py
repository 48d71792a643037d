"""Every registered query runs, and equals its SQL twin where it has one."""

import oracle
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_equals_sql(spark, folder, con, name):
    got = oracle.spark_rows(QUERIES[name](spark, folder))
    assert not oracle.differences(got, oracle.sql_rows(con, SQL[name]))


@pytest.mark.parametrize("name", ["r2_dedup_text", "r14_crosstab_row", "t10_zipf_table", "m2_kfold_stratified", "m5_residual_shape"])
def test_same_for_any_partitioning(spark, folder, con, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = oracle.spark_rows(QUERIES[name](spark, folder))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = oracle.spark_rows(QUERIES[name](spark, folder))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert not oracle.differences(one, many)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["source", "mean_sentiment", "mean_n_words", "n_docs"]
    assert rows.count() > 0


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)
