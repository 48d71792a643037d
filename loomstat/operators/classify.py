"""Classifiers: logit with inference, penalised logit, trees, forest, soft vote."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
import math

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.functions import probability
from loomstat.operators.evaluate import together
from loomstat.operators.linear import info_criteria
from loomstat.operators.reshape import union_all

# Inverse penalties and depths that are swept.
PENALTIES = [1e-4, 1e-3, 1e-2, 1e-1, 1.0, 5.0, 10.0, 50.0, math.inf]
TREE_DEPTHS = [*range(5, 16), 20, 25]


def assemble(df: DataFrame, xs: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., features, label) with complete rows only."""
    complete = df.select(*keep, *[F.col(f"`{x}`").cast("double").alias(f"_x{i}") for i, x in enumerate(xs)], F.col(label).cast("double").alias("label")).dropna()
    out = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(xs))], outputCol="features").transform(complete)
    return out.select(*keep, "features", "label")


def logit(df: DataFrame, y: str, xs: Sequence[str], max_iter: int = 35):
    """Maximum-likelihood logit of a 0/1 target; the fitted model carries the inference summary."""
    glm = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=max_iter, tol=1e-8)
    return glm.fit(assemble(df, xs, y))


def logit_coefficients(spark, model, xs: Sequence[str], level: float = 0.95) -> DataFrame:
    """Coefficient, standard error, z, p and limits; the summary lists the intercept last."""
    s = model.summary
    z = 1.959963984540054 if level == 0.95 else probability.student_quantile(0.5 + level / 2.0, 1e9)
    order = [len(xs), *range(len(xs))]
    values = [*[float(c) for c in model.coefficients], float(model.intercept)]
    rows = []
    for place, i in enumerate(order):
        b, se = values[i], float(s.coefficientStandardErrors[i])
        name = "const" if i == len(xs) else xs[i]
        rows.append((place, name, b, se, b / se, probability.normal_two_sided(b / se), b - z * se, b + z * se))
    return spark.createDataFrame(
        rows, "position int, term string, coef double, std_err double, z double, p_value double, low double, high double"
    )


def logit_summary(spark, model, n: int, p: int, max_iter: int = 35) -> DataFrame:
    """Log-likelihood, null log-likelihood, pseudo R2, LLR test, criteria, convergence."""
    s = model.summary
    ll, null = -s.deviance / 2.0, -s.nullDeviance / 2.0
    ic = info_criteria(ll, n, p)
    llr = 2.0 * (ll - null)
    return spark.createDataFrame(
        [(n, p, ll, null, 1.0 - ll / null, llr, probability.chi2_upper(llr, p), ic["aic"], ic["aicc"], ic["bic"], s.numIterations, s.numIterations < max_iter)],
        "n bigint, df_model int, ll double, ll_null double, pseudo_r2 double, llr double, llr_p double, aic double, "
        "aicc double, bic double, iterations int, converged boolean",
    )


def logit_l2(c: float, n: int, family: str = "auto", max_iter: int = 100) -> LogisticRegression:
    """L2-penalised logit in the inverse-penalty form: ``C * sum(loss) + |w|^2/2``.
    ``C = inf`` means no penalty. ``n`` is the number of training rows.

    The penalty is on the coefficients of the columns as given; without one
    standardising only helps the solver and leaves the solution alone.
    """
    free = math.isinf(c)
    return LogisticRegression(
        regParam=0.0 if free else 1.0 / (c * n), elasticNetParam=0.0, standardization=free, family=family,
        maxIter=max_iter, tol=1e-6,
    )


def decision_tree(depth: int, min_leaf: int = 5, seed: int = 12345) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed)


def random_forest(depth: int, trees: int = 100, min_leaf: int = 5, seed: int = 12345) -> RandomForestClassifier:
    return RandomForestClassifier(maxDepth=depth, numTrees=trees, minInstancesPerNode=min_leaf, seed=seed)


def feature_importance(spark, model, xs: Sequence[str], top: int = 15) -> DataFrame:
    rows = [(x, float(v)) for x, v in zip(xs, model.featureImportances.toArray())]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def soft_vote(df: DataFrame, models: dict[str, Model], keep: Sequence[str]) -> DataFrame:
    """Mean of the members' class probabilities and its arg-max, next to each
    member's own prediction. The models score one after another in the same
    pass over the rows."""
    out = df
    for i, model in enumerate(models.values()):
        copy = model.copy()
        copy.setPredictionCol(f"_pred{i}")
        copy.setProbabilityCol(f"_prob{i}")
        copy.setRawPredictionCol(f"_raw{i}")
        out = copy.transform(out).withColumn(f"_p{i}", vector_to_array(f"_prob{i}")).drop(f"_prob{i}", f"_raw{i}")
    total = F.col("_p0")
    for i in range(1, len(models)):
        total = F.zip_with(total, F.col(f"_p{i}"), lambda a, b: a + b)
    mean = F.transform(total, lambda v: v / F.lit(float(len(models))))
    voted = out.withColumn("vote_probability", mean)
    best = (F.array_position("vote_probability", F.array_max("vote_probability")) - 1).cast("double")
    members = [F.col(f"_pred{i}").alias(f"prediction_{name}") for i, name in enumerate(models)]
    return voted.select(*keep, "label", *members, "vote_probability", best.alias("prediction"))


def vote_accuracy(voted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy of every member and of the vote."""
    members = [c for c in voted.columns if c.startswith("prediction")]
    names = {c: c.removeprefix("prediction_") if c != "prediction" else "vote" for c in members}
    hits = voted.groupBy(*by).agg(*[F.avg((F.col(c) == F.col("label")).cast("double")).alias(names[c]) for c in members])
    cells = F.array(*[F.struct(F.lit(v).alias("member"), F.col(v).alias("accuracy")) for v in names.values()])
    return hits.select(*by, F.inline(cells))


def cross_validated_vote(df: DataFrame, makers: dict, k: int, fold: str = "fold", keep: Sequence[str] = ()) -> DataFrame:
    """Mean and spread over folds of the accuracy of each member and the vote."""

    def one(i: int) -> DataFrame:
        train = df.filter(F.col(fold) != i)
        models = {name: make().fit(train) for name, make in makers.items()}
        return soft_vote(df.filter(F.col(fold) == i), models, [fold, *keep])

    parts = union_all(*together([partial(one, i) for i in range(k)]))
    per_fold = vote_accuracy(parts, [fold])
    return per_fold.groupBy("member").agg(
        F.avg("accuracy").alias("accuracy_mean"), F.stddev_pop("accuracy").alias("accuracy_std")
    )
