"""Models with one 0/1 predictor, whose fits and cross-validated scores have closed forms that SQL can repeat."""

from __future__ import annotations

import math

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import functions as F

from loomstat.operators import classify, depths, evaluate, linear, selection, topics
from loomstat.operators.gram import gram
from loomstat.plans.catalog import WORDS_SQL, query, rounded, table
from loomstat.session import work_path
from loomstat.sources.tables import keep_packed, save_model

# The label follows the quantity but where the discount is high; the fold follows the order.
LARGE = "CAST(l_quantity > 25 AS INTEGER)"
PAIR_SQL = f"p AS (SELECT {LARGE} AS x, CASE WHEN l_discount > 0.08 THEN 1 - {LARGE} ELSE {LARGE} END AS label, l_orderkey % 3 AS fold FROM lineitem)"
# Any model of one 0/1 column calls the more frequent label of each side.
ALL_SQL = f"""WITH {PAIR_SQL}, r AS (SELECT x, CAST(avg(label) > 0.5 AS DOUBLE) AS prediction FROM p GROUP BY x)
    SELECT CAST(label AS DOUBLE) AS label, prediction, count(*) AS n FROM p JOIN r USING (x) GROUP BY ALL"""
FOLD_SQL = f"""WITH {PAIR_SQL}, f AS (SELECT DISTINCT fold FROM p),
    r AS (SELECT f.fold, x, CAST(avg(label) > 0.5 AS INTEGER) AS pred FROM p JOIN f ON p.fold <> f.fold GROUP BY f.fold, x),
    j AS (SELECT p.fold, label, pred FROM p JOIN r ON p.fold = r.fold AND p.x = r.x), k AS (SELECT unnest([0, 1]) AS c),
    m AS (SELECT fold, c, CAST(count(*) FILTER (WHERE label = c AND pred = c) AS DOUBLE) AS tp, count(*) FILTER (WHERE label = c) AS actual, count(*) FILTER (WHERE pred = c) AS called
        FROM j, k GROUP BY fold, c),
    s AS (SELECT fold, sum(tp) / sum(actual) AS accuracy, avg(coalesce(tp / nullif(called, 0), 0)) AS precision_macro, avg(coalesce(tp / nullif(actual, 0), 0)) AS recall_macro,
        avg(coalesce(2 * tp / nullif(called + actual, 0), 0)) AS f1_macro FROM m GROUP BY fold)"""
MEANS_SQL = ", ".join(f"round(avg({s}), 6) AS {s}_mean, round(stddev_pop({s}), 6) AS {s}_std" for s in evaluate.SCORES)


def _sweep_sql(name: str, values: list[str]) -> str:
    """Both settings call the same labels, so the first is the best."""
    rows = ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))
    return FOLD_SQL + f" SELECT CAST(position AS INTEGER) AS position, value AS {name}, {MEANS_SQL}, position = 0 AS best FROM s, (VALUES {rows}) AS v(position, value) GROUP BY position, value"


def _pair(spark, d, xs=("x",)):
    """(features, label, fold) of every line item."""
    lines = table(spark, d, "lineitem")
    x = (F.col("l_quantity") > 25).cast("double")
    rows = lines.select(
        x.alias("x"), (F.col("l_tax") > 0.04).cast("double").alias("taxed"), F.when(F.col("l_discount") > 0.08, 1 - x).otherwise(x).alias("label"), (F.col("l_orderkey") % 3).cast("int").alias("fold")
    )
    return classify.assemble(rows, xs, "label", ["fold"])


@query(ALL_SQL)
def m18_tree_one_factor(spark, d):
    """Confusion counts of a tree with one split."""
    rows = _pair(spark, d)
    return evaluate.confusion(classify.decision_tree(1).fit(rows).transform(rows))


@query(ALL_SQL)
def m19_forest_one_factor(spark, d):
    """Confusion counts of a forest of such trees."""
    rows = _pair(spark, d)
    return evaluate.confusion(classify.random_forest(1, trees=20).fit(rows).transform(rows))


@query(ALL_SQL)
def s8_save_tree_one_factor(spark, d):
    """The tree with one split stored, loaded again and applied."""
    rows = _pair(spark, d)
    path = work_path(spark, "tree")
    save_model(classify.decision_tree(1).fit(rows), path)
    return evaluate.confusion(DecisionTreeClassificationModel.load(path).transform(rows))


@query(
    f"""WITH q AS (SELECT x, CAST(l_tax > 0.04 AS INTEGER) AS taxed, label FROM (SELECT {LARGE} AS x, l_tax, CASE WHEN l_discount > 0.08 THEN 1 - {LARGE} ELSE {LARGE} END AS label FROM lineitem)),
        g AS (SELECT 'x' AS feature, x AS side, label FROM q UNION ALL SELECT 'taxed', taxed, label FROM q),
        i AS (SELECT feature, sum(n * r * (1 - r)) AS impurity FROM (SELECT feature, side, count(*) AS n, avg(label) AS r FROM g GROUP BY ALL) GROUP BY feature)
        SELECT feature, CAST(impurity = (SELECT min(impurity) FROM i) AS DOUBLE) AS importance FROM i"""
)
def m20_importance_one_split(spark, d):
    """One split between two columns: the purer one has all importance."""
    xs = ["x", "taxed"]
    return classify.feature_importance(spark, classify.decision_tree(1).fit(_pair(spark, d, xs)), xs)


@query(FOLD_SQL + " UNION ALL ".join(f" SELECT '{s}' AS metric, round(avg({s}), 6) AS mean, round(stddev_pop({s}), 6) AS std FROM s" for s in evaluate.SCORES))
def m16_cross_validate_one_factor(spark, d):
    """Scores over three folds of a tree with one split."""
    return rounded(evaluate.cross_validate(_pair(spark, d), lambda: classify.decision_tree(1), 3))


@query(_sweep_sql("C", ["1.0", "inf"]))
def m7_sweep_one_factor(spark, d):
    """A light and no penalty call the same labels."""
    rows, n = keep_packed(_pair(spark, d))
    settings = {c: (lambda c=c: classify.logit_l2(c, n * 2 // 3)) for c in (1.0, math.inf)}
    return rounded(evaluate.sweep(rows, "C", settings, 3))


@query(_sweep_sql("depth", ["1", "4"]))
def m17_depths_one_factor(spark, d):
    """Depths beyond the first find no further split."""
    return rounded(depths.sweep_depths(_pair(spark, d), "depth", classify.decision_tree, [1, 4], 3))


@query(
    FOLD_SQL + """ SELECT member, round(avg(accuracy), 6) AS accuracy_mean, round(stddev_pop(accuracy), 6) AS accuracy_std
        FROM s, (VALUES ('tree'), ('logit'), ('vote')) AS v(member) GROUP BY member"""
)
def m21_vote_one_factor(spark, d):
    """Members that agree, and so does their vote."""
    rows, n = keep_packed(_pair(spark, d))
    makers = {"tree": lambda: classify.decision_tree(1), "logit": lambda: classify.logit_l2(math.inf, n)}
    return rounded(classify.cross_validated_vote(rows, makers, 3))


@query(
    """WITH t AS (SELECT covar_pop(l_extendedprice, l_quantity) AS c, var_pop(l_quantity) AS v FROM lineitem),
        a AS (SELECT unnest([0.1, 10.0, 100.0]::DOUBLE[]) AS alpha), r AS (SELECT unnest([0.0, 0.5, 1.0]::DOUBLE[]) AS l1_ratio)
        SELECT alpha, l1_ratio, 'l_quantity' AS term, round(sign(c) * greatest(abs(c) - alpha * l1_ratio, 0) / (v + alpha * (1 - l1_ratio)), 6) + 0.0 AS coef FROM t, a, r"""
)
def m9_shrinkage_one(spark, d):
    """One predictor: the soft threshold over the variance and the ridge part of the penalty."""
    steps = linear.shrinkage_path(table(spark, d, "lineitem"), "l_extendedprice", ["l_quantity"], [0.1, 10.0, 100.0], [0.0, 0.5, 1.0])
    return linear.path_coefficients(spark, steps).withColumn("coef", F.round("coef", 6) + F.lit(0.0))


@query(
    """WITH s AS (SELECT CAST(count(*) AS DOUBLE) AS n, regr_syy(l_extendedprice, l_quantity) AS sst, regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity)) AS sse FROM lineitem),
        b AS (SELECT n * (ln(2 * pi()) + 1 + ln(sst / n)) + 2 * ln(n) AS b0, n * (ln(2 * pi()) + 1 + ln(sse / n)) + 3 * ln(n) AS b1 FROM s)
        SELECT CAST(0 AS INTEGER) AS generation, CAST(30 AS BIGINT) AS n_evaluated, CAST(b1 < b0 AS INTEGER) AS features, round(abs(b0 - b1), 4) AS range,
            round(least(b0, b1), 4) AS min, round(greatest(b0, b1), 4) AS max, round(ln(least(b0, b1)), 8) AS ln_fit FROM b"""
)
def m24_first_generation(spark, d):
    """The log of the start population of a search over one column, which holds both subsets."""
    g = gram(table(spark, d, "lineitem"), ["l_quantity"], "l_extendedprice")
    result = selection.genetic_select(selection.LinearFitness(g, "bic"), ["l_quantity"], n_generation=0)
    log = selection.generation_log(spark, result)
    return log.select("generation", "n_evaluated", F.col("features").cast("int").alias("features"), *[F.round(c, 4).alias(c) for c in ("range", "min", "max")], F.round("ln_fit", 8).alias("ln_fit"))


@query(
    f"""WITH w AS (SELECT doc_id % 3 AS cluster, term, CAST(count(*) AS DOUBLE) AS v FROM (SELECT doc_id, {WORDS_SQL} AS term FROM documents) GROUP BY ALL),
        n AS (SELECT doc_id % 3 AS cluster, count(*) AS n FROM documents GROUP BY 1), a AS (SELECT term, sum(v) AS all_v FROM w GROUP BY term),
        l AS (SELECT cluster, term, v / n - all_v / (SELECT sum(n) FROM n) AS lift FROM w JOIN n USING (cluster) JOIN a USING (term))
        SELECT CAST(cluster AS INTEGER) AS cluster, term, round(lift, 6) AS lift FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY lift DESC, term) AS place FROM l) WHERE place <= 15"""
)
def t23_cluster_terms_rule(spark, d):
    """Terms most above the mean of all documents, of three rule clusters."""
    docs = table(spark, d, "documents")
    weights = topics.doc_weights(docs, "doc_id", weighted=False)
    assigned = docs.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("cluster"))
    return rounded(topics.cluster_terms(weights, "doc_id", assigned, 15).select("cluster", "term", "lift"))


@query(
    """WITH c AS (SELECT doc_id % 3 AS k, avg(n_chars) AS x, avg(doc_id) AS y FROM documents GROUP BY 1)
       SELECT CAST(p.k AS INTEGER) AS a, CAST(q.k AS INTEGER) AS b, round(sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)), 4) AS distance FROM c p JOIN c q ON p.k < q.k"""
)
def t23_centre_distances_rule(spark, d):
    """Distances between the centres of the rule clusters in two measures."""
    docs = table(spark, d, "documents").groupBy((F.col("doc_id") % 3).alias("k")).agg(F.avg("n_chars").alias("x"), F.avg("doc_id").alias("y"))
    centres = [(r.x, r.y) for r in sorted(docs.collect(), key=lambda r: r.k)]
    return rounded(topics.centre_distances(spark, centres), 4)
