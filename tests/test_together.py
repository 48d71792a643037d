"""Counts of texts dealt by key: words are not shuffled, and rows with the same or no key are still counted as one document."""

from pyspark.sql import functions as F

from loomstat.operators import terms


def test_words_are_not_shuffled(spark, tmp_path):
    rows = [(i % 40 if i % 9 else None, f"a b{i % 3} a") for i in range(80)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "id long, text string").repartition(8).write.parquet(path)
    docs = spark.read.option("maxPartitionBytes", 1).parquet(path)
    docs = docs.union(docs.where("id < 0"))
    assert docs.rdd.getNumPartitions() * 2 > spark.sparkContext.defaultParallelism
    counts = terms.doc_term(terms.tokenize(docs, "id", together=True), "id")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "text" in plan.split("Exchange hashpartitioning")[1]
    plain = terms.doc_term(terms.tokenize(docs, "id"), "id")
    order = [F.col("id").asc_nulls_first(), "term"]
    assert counts.orderBy(*order).collect() == plain.orderBy(*order).collect()
