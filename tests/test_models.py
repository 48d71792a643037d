"""Classifiers on rows with a planted rule, and the incremental jobs."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from loomstat import session
from loomstat.operators import classify, evaluate, sentiment
from loomstat.streaming import articles as streams


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, size=(400, 3))
    label = ((x[:, 0] > 0.1) ^ (x[:, 1] > 0.4)).astype(float)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(label[i])) for i in range(400)], "id bigint, a double, b double, c double, y double")
    return evaluate.kfold(classify.assemble(df, ["a", "b", "c"], "y", ["id"]), "id", 4, stratify="label").cache()


def test_tree_forest_and_vote(spark, rows):
    makers = {
        "forest": lambda: classify.random_forest(6, trees=20),
        "tree": lambda: classify.decision_tree(6),
        "logit": lambda: classify.logit_l2(1.0, 300),
    }
    accuracy = {r.member: r.accuracy_mean for r in classify.cross_validated_vote(rows, makers, 4).collect()}
    assert accuracy["tree"] > 0.9 and accuracy["forest"] > 0.9 and accuracy["vote"] > 0.85
    models = {name: make().fit(rows) for name, make in makers.items()}
    voted = classify.soft_vote(rows, models, ["id"])
    assert voted.filter(F.abs(F.col("vote_probability")[0] + F.col("vote_probability")[1] - 1) > 1e-9).count() == 0
    top = classify.feature_importance(spark, models["forest"], ["a", "b", "c"], 3).collect()
    assert {r.feature for r in top[:2]} == {"a", "b"}


def test_sweep_flags_the_first_best(rows):
    table = evaluate.sweep(rows, "depth", {d: (lambda d=d: classify.decision_tree(d)) for d in (1, 5, 6)}, 4).orderBy("position").collect()
    scores = [r.f1_macro_mean for r in table]
    assert [r.best for r in table] == [i == scores.index(max(scores)) for i in range(3)]
    assert scores[0] < scores[1]


def test_cross_validation_matches_by_hand(rows):
    make = lambda: classify.decision_tree(3)
    got = {r.metric: r for r in evaluate.cross_validate(rows, make, 4).collect()}
    by_hand = []
    for i in range(4):
        pdf = make().fit(rows.filter(F.col("fold") != i)).transform(rows.filter(F.col("fold") == i)).select("label", "prediction").toPandas()
        f1 = []
        for c in (0.0, 1.0):
            tp = ((pdf.label == c) & (pdf.prediction == c)).sum()
            f1.append(2 * tp / ((pdf.label == c).sum() + (pdf.prediction == c).sum()))
        by_hand.append(np.mean(f1))
    assert got["f1_macro"].mean == pytest.approx(np.mean(by_hand)) and got["f1_macro"].std == pytest.approx(np.std(by_hand))


def test_logit_penalty_shrinks(rows):
    norms = [float(np.linalg.norm(classify.logit_l2(c, 400).fit(rows).coefficients.toArray())) for c in (1e-4, 1e-2, 1.0, float("inf"))]
    assert norms == sorted(norms)


def test_stream_equals_batch(spark):
    docs = [(i, f"s{i % 3}", "good bad good" if i % 4 else "bad") for i in range(50)]
    table = spark.createDataFrame(docs, "id bigint, source string, text string")
    path = session.work_path(spark, "t")
    table.repartition(3).write.parquet(path)
    lexicon = {"good": 1.0, "bad": -2.0}
    schema = "id bigint, source string, text string"
    out, state = session.work_path(spark, "t"), session.work_path(spark, "t")
    for _ in range(2):  # a restart with nothing new changes nothing
        stream = streams.article_stream(spark, path, schema, files_per_batch=1)
        streams.running_group_sentiment(stream, lexicon, "source", "text", out, state).awaitTermination()
    got = {r.source: (r.mean_sentiment, r.n_docs) for r in streams.latest_result(spark, out).collect()}
    scores = sentiment.sentiment_scores(table, lexicon, "id", carry=["source"])
    want = {r.source: (r.mean_sentiment, r.n_docs) for r in sentiment.sentiment_by_group(scores, "source").collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k] == pytest.approx(want[k])


def test_incremental_articles_across_runs(spark):
    path, out, state = (session.work_path(spark, "t") for _ in range(3))
    schema = "url string, day int"
    for day, names in enumerate([["a", "b", "b"], ["b", "c"], ["a", "c", "d"]]):
        spark.createDataFrame([(n, day) for n in names], schema).coalesce(1).write.mode("append").parquet(path)
        stream = streams.article_stream(spark, path, schema)
        streams.incremental_articles(stream, out, state, ["url"]).awaitTermination()
        kept = {r.url: r.day for r in spark.read.parquet(out).collect()}
    assert kept == {"a": 0, "b": 0, "c": 1, "d": 2} and spark.read.parquet(out).count() == 4


def test_late_articles_with_a_watermark(spark):
    path, out, state = (session.work_path(spark, "t") for _ in range(3))
    schema = "url string, at timestamp"
    for batch in [[("a", "2024-01-01"), ("b", "2024-01-20")], [("b", "2024-01-21"), ("old", "2024-01-02"), ("c", "2024-01-22")]]:
        rows = spark.createDataFrame(batch, "url string, at string").selectExpr("url", "cast(at as timestamp) at")
        rows.coalesce(1).write.mode("append").parquet(path)
        stream = streams.article_stream(spark, path, schema)
        streams.incremental_articles(stream, out, state, ["url"], event_time="at", delay="5 days").awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_cluster_session_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.shared_root(Session())
