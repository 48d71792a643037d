"""Depths read off one deep fit equal separate fits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loomstat.operators import classify, depths, evaluate

DEPTHS = [1, 3, 6, 10]


@pytest.fixture(scope="module")
def rows(spark):
    cols = [F.rand(i).alias(f"x{i}") for i in range(4)]
    df = spark.range(900).repartition(2).select("id", *cols, F.rand(8).alias("u"))
    score = F.col("x0") + F.col("x1") * F.col("x2") + 0.5 * F.col("u")
    df = df.withColumn("label", F.when(score > 1.2, 2.0).when(score > 0.8, 1.0).otherwise(0.0)).withColumn("fold", (F.col("id") % 3).cast("int"))
    return VectorAssembler(inputCols=[f"x{i}" for i in range(4)], outputCol="features").transform(df).persist()


def forest(depth):
    return classify.random_forest(depth, trees=7)


@pytest.mark.parametrize("make", [classify.decision_tree, forest])
def test_heads_equal_separate_fits(spark, rows, make):
    deep = depths.nodes_of(spark, make(max(DEPTHS)).fit(rows))
    x = np.array([r.f for r in rows.orderBy("id").select(vector_to_array("features").alias("f")).collect()])
    found = deep.predictions(x, DEPTHS)
    for j, depth in enumerate(DEPTHS):
        apart = make(depth).fit(rows).transform(rows).orderBy("id").select("prediction").collect()
        assert found[:, j].tolist() == [r.prediction for r in apart]


@pytest.mark.parametrize("make", [classify.decision_tree, forest])
def test_sweep_equals_one_fit_per_depth(rows, make):
    settings = {d: (lambda d=d: make(d)) for d in [6, 1, 3]}
    apart = evaluate.sweep(rows, "depth", settings, 3).orderBy("position").collect()
    together = depths.sweep_depths(rows, "depth", make, [6, 1, 3], 3).orderBy("position").collect()
    assert [r.depth for r in together] == ["6", "1", "3"] and [r.best for r in together] == [r.best for r in apart]
    for a, b in zip(apart, together):
        assert a.asDict() == pytest.approx(b.asDict())


def test_one_leaf(spark, rows):
    same = rows.withColumn("label", F.lit(0.0))
    nodes = depths.nodes_of(spark, classify.decision_tree(4).fit(same))
    assert nodes.predictions(np.zeros((3, 4)), [1, 4]).tolist() == [[0.0, 0.0]] * 3
