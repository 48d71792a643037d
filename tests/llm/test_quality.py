"""The discriminant equals plain normal densities, and held-out rows are told apart."""

import random
import zlib

import numpy as np
import pytest

from loomstat.llm import quality
from loomstat.llm.queries import op13_quality

P = len(quality.STATISTICS)


def density(x, mean, cov):
    d = x - mean
    return -0.5 * (d * np.linalg.solve(cov, d.T).T).sum(axis=1) - 0.5 * np.linalg.slogdet(cov)[1]


def plain_margins(x, y, at, pooling, diagonal):
    cov = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum((y == k).mean() * cov[k] for k in (0, 1))
    out = []
    for k in (0, 1):
        drawn = (1 - pooling) * cov[k] + pooling * pooled
        drawn = (1 - diagonal) * drawn + diagonal * np.diag(np.maximum(np.diag(pooled), quality.LEAST_VARIANCE)) + quality.LEAST_VARIANCE * np.eye(P)
        out.append(density(at, x[y == k].mean(axis=0), drawn) + np.log((y == k).mean()))
    return out[1] - out[0]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def auc(scores, labels):
    one, zero = np.array(scores)[np.array(labels) == 1], np.array(scores)[np.array(labels) == 0]
    return ((one[:, None] > zero).mean() + 0.5 * (one[:, None] == zero).mean()).item()


@pytest.fixture(scope="module")
def planted(make_docs, spark):
    """Plain sentences, and shouted, repeated or marked ones."""
    rng = random.Random(7)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts, labels = [], []
    for i in range(400):
        chosen = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        good = i % 4 != 0
        if not good:
            how = i // 4 % 3
            chosen = [w.upper() + "!!" for w in chosen] if how == 0 else [chosen[0]] * len(chosen) if how == 1 else [w + "%%%" for w in chosen]
        texts.append(" ".join(chosen) + ".")
        labels.append((i, int(good)))
    return make_docs(texts), spark.createDataFrame([r for r in labels if r[0] % 3], "doc_id long, quality int"), labels


@pytest.mark.parametrize("pooling, diagonal", [(0.0, 0.001), (0.3, 0.05), (1.0, 0.2)])
def test_margins_equal_plain_densities(spark, pooling, diagonal):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, P)) @ rng.normal(size=(P, P)) + 4
    y = (rng.random(300) < 0.3).astype(int)
    rows = spark.createDataFrame([(i % quality.FOLDS, int(k), v.tolist()) for i, (k, v) in enumerate(zip(y, x))], "fold int, label int, stats array<double>")
    found = quality.moments(rows)
    classes = [sum((m for (_, k), m in found.items() if k == label), quality.NOTHING) for label in (0, 1)]
    assert sum(m.n for m in classes) == 300
    got = quality.discriminant(classes, pooling, diagonal).margins(x)
    np.testing.assert_allclose(got, plain_margins(x, y, x, pooling, diagonal), rtol=1e-6, atol=1e-6)


def test_setting_of_least_cross_validated_loss(planted):
    docs, labels, _ = planted
    stats = quality.document_statistics(docs)
    model = quality.fit(stats, labels)
    known = {r.doc_id: r.quality for r in labels.collect() if not held(r.doc_id)}
    rows = [(r.doc_id, known[r.doc_id], np.array(r.stats)) for r in stats.collect() if r.doc_id in known]
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    ids = stats.sparkSession.createDataFrame([(r[0],) for r in rows], "doc_id long")
    folds = {r.doc_id: r.f for r in ids.selectExpr("doc_id", f"pmod(xxhash64('fold', doc_id), {quality.FOLDS}) f").collect()}
    fold = np.array([folds[r[0]] for r in rows])
    losses = []
    for pooling in quality.POOLINGS:
        for diagonal in quality.DIAGONALS:
            margins = np.concatenate([np.where(y[fold == f] == 1, -1, 1) * plain_margins(x[fold != f], y[fold != f], x[fold == f], pooling, diagonal) for f in range(quality.FOLDS)])
            losses.append((np.logaddexp(0, margins).sum(), pooling, diagonal))
    _, pooling, diagonal = min(losses)
    np.testing.assert_allclose(model.margins(x), plain_margins(x, y, x, pooling, diagonal), rtol=1e-5, atol=1e-5)


def test_planted_rows(planted):
    docs, labels, truth = planted
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    unseen = [(i, y) for i, y in truth if i % 3 == 0 or held(i)]
    assert auc([scores[i] for i, _ in unseen], [y for _, y in unseen]) > 0.99
    assert np.mean([(scores[i] >= 0.3) == y for i, y in unseen]) > 0.97


def test_held_out_labels_do_not_matter(planted, spark):
    docs, labels, truth = planted
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    turned = turned.union(spark.createDataFrame([(10**6, 1), (10**6 + 1, 7), (None, 1)], "doc_id long, quality int"))
    first = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    second = {r.doc_id: r.score for r in quality.score_quality(docs, turned).collect()}
    assert first == pytest.approx(second, rel=1e-9)


def test_awkward_texts(awkward, nothing, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(25)] + [(100, 1), (100, 0), (3, None)], "doc_id long, quality int")
    rows = quality.score_quality(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 100}) == 1
    assert len({r.score for r in rows if r.doc_id in (0, 1)}) == 1  # null and empty texts
    assert quality.score_quality(nothing, labels).count() == 0
    no_labels = labels.limit(0)
    assert {r.score for r in quality.score_quality(awkward, no_labels).collect()} == {0.5}
    ones = labels.where("quality = 1 and doc_id < 25")
    assert {round(r.score, 3) for r in quality.score_quality(awkward, ones).collect()} == {1.0}


def test_whole_table(spark, folder):
    rows = {r.doc_id: r for r in op13_quality(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == held(i) and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    unseen = [(rows[r.doc_id].score, r.quality) for r in labels if held(r.doc_id) and r.doc_id in rows]
    assert auc(*map(list, zip(*unseen))) > 0.9
