"""Identities and brute-force checks of the regression operators."""

import itertools
import math

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
import pytest

from loomstat.functions import probability
from loomstat.operators import diagnostics, evaluate, gram, linear, logistic, quantile, selection


@pytest.fixture(scope="module")
def rows(spark):
    """Two strong columns, one weak, two noise columns, one copy of the first."""
    rng = np.random.default_rng(5)
    n = 600
    x = rng.normal(size=(n, 5)) * [1, 10, 3, 1, 1] + [1000, 0, 5, 0, 0]
    y = 4 * x[:, 0] - 0.7 * x[:, 1] + 0.2 * x[:, 2] + rng.normal(size=n)
    label = (x[:, 0] - 1000 + 0.1 * x[:, 1] + rng.logistic(size=n) > 0).astype(float)
    data = [(i, *map(float, x[i]), float(x[i, 0] * 2), float(y[i]), float(label[i])) for i in range(n)]
    return spark.createDataFrame(data, "id bigint, a double, b double, c double, d double, e double, copy double, y double, label double").repartition(3).cache()


XS = ["a", "b", "c", "d", "e"]


def arrays(rows, xs=XS, y="y"):
    pdf = rows.orderBy("id").toPandas()
    return pdf[xs].to_numpy(), pdf[y].to_numpy()


def test_both_gram_paths_agree(rows, monkeypatch):
    x, y = arrays(rows)
    full = np.column_stack([np.ones(len(y)), x, y])
    for width in (0, 100):
        monkeypatch.setattr(gram, "SQL_WIDTH", width)
        g = gram.gram(rows, XS, "y")
        assert np.allclose(g.raw, full.T @ full, rtol=1e-9)


def test_gram_leaves_out_incomplete_rows(rows, monkeypatch):
    holes = rows.withColumn("a", F.when(F.col("id") % 7 > 0, F.col("a"))).withColumn("b", F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("b")))
    want = rows.filter("id % 7 > 0 and id % 5 > 0").count()
    for width in (0, 100):
        monkeypatch.setattr(gram, "SQL_WIDTH", width)
        assert gram.gram(holes, XS, "y").n == want


def test_ols_equals_library(spark, rows):
    fit = linear.ols(rows, "y", XS)
    model = LinearRegression(solver="normal", labelCol="y").fit(VectorAssembler(inputCols=XS, outputCol="features").transform(rows))
    assert np.allclose(fit.coef, model.coefficients.toArray(), rtol=1e-6)
    order = [len(XS), *range(len(XS))]
    assert np.allclose(fit.std_err, np.array(model.summary.coefficientStandardErrors)[order], rtol=1e-5)
    table = {r.term: r for r in linear.coefficient_table(spark, fit).collect()}
    assert np.allclose(table["a"].p_value, model.summary.pValues[0], atol=1e-9)
    assert linear.strongest_attribute(linear.coefficient_table(spark, fit)).first().term in ("a", "b")


def test_collinear_columns(rows):
    fit = linear.ols(rows, "y", ["a", "copy"])
    single = linear.ols(rows, "y", ["a"])
    assert fit.rank == 1
    assert math.isclose(fit.sse, single.sse, rel_tol=1e-9)


def test_influence_identities(rows):
    fit = linear.ols(rows, "y", XS)
    found = diagnostics.influence(rows, fit, ["id"])
    sums = found.agg(F.sum("leverage").alias("h"), F.sum("residual").alias("r"), F.sum(F.col("residual") ** 2).alias("sse")).first()
    assert math.isclose(sums.h, len(XS) + 1, rel_tol=1e-9)
    assert abs(sums.r) < 1e-6
    assert math.isclose(sums.sse, fit.sse, rel_tol=1e-9)


def test_leverage_paths_agree(rows, monkeypatch):
    fit = linear.ols(rows, "y", XS)
    one = [r.leverage for r in diagnostics.influence(rows, fit, ["id"]).orderBy("id").collect()]
    monkeypatch.setattr(diagnostics, "EXPRESSION_WIDTH", 0)
    two = [r.leverage for r in diagnostics.influence(rows, fit, ["id"]).orderBy("id").collect()]
    assert np.allclose(one, two)


def test_lasso_optimality(rows):
    x, y = arrays(rows)
    xc, yc = x - x.mean(0), y - y.mean()
    for step in linear.shrinkage_path(rows, "y", XS, [0.05, 0.5, 3.0], [1.0, 0.5]):
        slope = xc.T @ (yc - xc @ step.coef) / len(y) - step.alpha * (1 - step.l1_ratio) * step.coef
        for j, w in enumerate(step.coef):
            if w:
                assert math.isclose(slope[j], math.copysign(step.alpha * step.l1_ratio, w), abs_tol=1e-5)
            else:
                assert abs(slope[j]) <= step.alpha * step.l1_ratio + 1e-6


def test_gram_error_of_any_model(rows):
    x, y = arrays(rows)
    coef = np.array([1.0, 2.0, -1.0, 0.5, 0.0])
    want = ((y - 3.0 - x @ coef) ** 2).sum()
    assert math.isclose(gram.gram(rows, XS, "y").sse(3.0, coef), want, rel_tol=1e-9)


def test_information_criteria_of_a_published_fit():
    ll, n, p = -439947.0768, 51999, 20
    ic = linear.info_criteria(ll, n, p)
    assert math.isclose(ic["aic"], 879938.1537, abs_tol=2e-4)
    assert math.isclose(ic["aicc"], 879938.1732, abs_tol=2e-4)
    assert math.isclose(ic["bic"], 880133.0512, abs_tol=2e-4)
    assert linear.info_criteria(-10.0, 100, 3, n_cat=5)["aic"] == 20.0 + 2 * (5 * 4 + 1)


def test_durbin_watson(rows):
    want_rows = rows.orderBy("id").toPandas()["e"].to_numpy()
    want = (np.diff(want_rows) ** 2).sum() / (want_rows**2).sum()
    for buckets in (1, 7, 256):
        got = linear.durbin_watson(rows, "e", "id", buckets).first()[0]
        assert math.isclose(got, want, rel_tol=1e-9)


@pytest.mark.parametrize("small", [3, 10_000])
def test_exact_median(spark, monkeypatch, small):
    monkeypatch.setattr(quantile, "SMALL", small)
    monkeypatch.setattr(quantile, "BINS", 8)
    rng = np.random.default_rng(1)
    groups = {
        "skewed": rng.lognormal(3, 3, 501), "even": rng.normal(size=400), "two": np.array([1.0] * 50 + [5.0] * 50),
        "same": np.full(30, 2.5), "tied": rng.integers(0, 4, 333).astype(float), "one": np.array([7.0]),
    }
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    got = quantile.exact_medians(df, "v", "g")
    for name, values in groups.items():
        assert got[name] == pytest.approx(float(np.median(values)), rel=1e-15), name


def test_tail_probabilities():
    assert math.isclose(probability.student_two_sided(2.0, 10), 0.0733880348, rel_tol=1e-7)
    assert math.isclose(probability.student_quantile(0.975, 10), 2.2281388520, rel_tol=1e-8)
    assert math.isclose(probability.chi2_upper(20.0, 5), 0.0012497306, rel_tol=1e-6)
    assert math.isclose(probability.f_upper(3.0, 4, 20), 0.0432009983, rel_tol=1e-7)
    assert math.isclose(probability.normal_two_sided(1.991), 0.0464809, rel_tol=1e-4)


def every_subset(width):
    return [c for k in range(width + 1) for c in itertools.combinations(range(width), k)]


@pytest.mark.parametrize("criterion", ["bic", "aic", "adjr2"])
def test_genetic_search_finds_the_best_subset(rows, criterion):
    fitness = selection.LinearFitness(gram.gram(rows, XS, "y"), criterion)
    result = selection.genetic_select(fitness, XS, n_generation=30)
    scores = fitness.score(every_subset(5))
    best = max(scores) if criterion == "adjr2" else min(scores)
    assert math.isclose(result.fitness, best, rel_tol=1e-12)
    assert result.distinct <= 32 <= result.evaluated


def test_generation_log(spark, rows):
    result = selection.genetic_select(selection.LinearFitness(gram.gram(rows, XS, "y")), XS, n_generation=8)
    log = selection.generation_log(spark, result).collect()
    assert [r.generation for r in log] == list(range(9))
    assert log[0].n_evaluated == selection.LEAST_POPULATION and all(r.min <= r.avg + 1e-9 <= r.max + 2e-9 for r in log)
    assert log[-1].min == pytest.approx(result.fitness)


def test_linear_stepwise(rows):
    names, moves = selection.stepwise(gram.gram(rows, XS, "y"))
    assert {"a", "b", "c"} <= set(names)
    fit = linear.ols(rows, "y", names)
    assert all(probability.student_two_sided(float(t), fit.df_error) <= 0.1 for t in fit.t_values[1:])
    first = min(XS, key=lambda c: linear.ols(rows, "y", [c]).sse)
    assert moves[0].feature == first


def newton(x, y):
    design = np.column_stack([np.ones(len(y)), x - x.mean(0)])
    b = np.zeros(design.shape[1])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-design @ b))
        b = b + np.linalg.solve((design * (mu * (1 - mu))[:, None]).T @ design, design.T @ (y - mu))
    mu = 1 / (1 + np.exp(-design @ b))
    return (y * np.log(mu) + (1 - y) * np.log(1 - mu)).sum(), b[1:]


def test_batched_logit(rows):
    batch = logistic.LogitBatch(rows, XS, "label")
    subsets = [(), (0,), (1, 0), (0, 1, 2, 3, 4)]
    for cols, fit in zip(subsets, batch.fit(subsets)):
        x, y = arrays(rows, [XS[c] for c in sorted(cols)] or ["a"], "label")
        if not cols:
            assert math.isclose(fit.ll, batch.null_ll, rel_tol=1e-9)
            continue
        ll, b = newton(x, y)
        assert fit.converged
        assert math.isclose(fit.ll, ll, rel_tol=1e-8)
        assert np.allclose(fit.coef[1:], b, rtol=1e-4)
    passes = batch.passes
    batch.fit(subsets)
    assert batch.passes == passes
    batch.close()


def test_separated_logit_does_not_settle(spark):
    df = spark.createDataFrame([(float(i), float(i > 20), float(i % 3)) for i in range(40)], "x double, y double, z double")
    batch = logistic.LogitBatch(df, ["x", "z"], "y")
    fitness = selection.LogitFitness(batch, "bic")
    assert fitness.score([(0,)]) == [math.inf]
    assert math.isfinite(fitness.score([(1,)])[0])
    batch.close()


def test_logistic_search(rows):
    batch = logistic.LogitBatch(rows, XS, "label")
    fitness = selection.LogitFitness(batch, "bic")
    result = selection.genetic_select(fitness, XS, n_generation=30)
    assert math.isclose(result.fitness, min(fitness.score(every_subset(5))), rel_tol=1e-9)
    names, _ = selection.stepwise(batch)
    assert {"a", "b"} <= set(names)
    batch.close()


def test_folds_are_balanced(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") % 10 < 7, 1).otherwise(0))
    sizes = evaluate.kfold(df, "id", 7, stratify="label", buckets=16).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r.label == label]
        assert len(counts) == 7 and max(counts) - min(counts) <= 1


def test_published_confusion_scores(spark):
    cells = spark.createDataFrame([(0, 0, 4632), (0, 1, 127), (1, 0, 320), (1, 1, 251)], "label int, prediction int, n bigint")
    s = evaluate.binary_scores(cells).first()
    assert [round(v, 4) for v in (s.accuracy, s.precision, s.recall, s.specificity, s.f1)] == [0.9161, 0.6640, 0.4396, 0.9733, 0.5290]
    assert s.n_wrong == 447 and round(s.pct_wrong, 1) == 8.4 and round(s.pct_wrong_0, 1) == 2.7 and round(s.pct_wrong_1, 1) == 56.0


def test_medians_with_infinities(spark):
    from loomstat.operators.quantile import exact_medians

    inf = float("inf")
    values = {"a": [inf, *range(20001)], "b": [-inf] * 3 + [1.0, 2.0], "c": [-inf, inf], "d": [1.0, 5.0, inf, inf], "e": [inf, inf, inf, 1.0], "f": [float("nan"), 4.0]}
    df = spark.createDataFrame([(s, float(v)) for s, vs in values.items() for v in vs], "s string, v double")
    got = exact_medians(df, "v", "s")
    assert got["a"] == 10000.5 and got["b"] == -inf and got["d"] == inf and got["e"] == inf and got["f"] == 4.0
    assert got["c"] != got["c"]


def test_genetic_search_equals_exhaustive_search_on_few_columns(spark):
    import itertools
    import random

    from loomstat.operators import selection
    from loomstat.operators.logistic import LogitBatch

    rng = random.Random(8)
    rows = []
    for _ in range(600):
        x = [rng.gauss(0, 1) for _ in range(5)]
        z = 1.2 * x[0] - 0.9 * x[2] + 0.5 * x[4] + rng.gauss(0, 1)
        rows.append((*x, float(z > 0)))
    names = [f"x{i}" for i in range(5)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y double")
    batch = LogitBatch(frame, names, "y")
    fitness = selection.LogitFitness(batch, "bic")
    found = selection.genetic_select(fitness, names, n_generation=8)
    subsets = [tuple(c) for k in range(6) for c in itertools.combinations(range(5), k)]
    scores = dict(zip(subsets, fitness.score(subsets)))
    batch.close()
    assert found.best == min(scores, key=scores.get) and found.distinct > 20
