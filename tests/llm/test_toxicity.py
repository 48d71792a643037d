"""Held-out accuracy, planted documents and awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import toxicity
from loomstat.llm.common import held_out


@pytest.fixture(scope="module")
def planted(spark):
    """Prose of invented words; toxic rows hold insults or made-up words with two beginnings. Labels cover three quarters of the rows."""
    rng = random.Random(3)
    prose = ["".join(rng.choice(["an", "er", "ti", "on", "sh", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(1500):
        words = rng.choices(prose, k=rng.randint(5, 120))
        toxic = i % 9 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                bad = rng.choice(["idiot", "moron", "Scum"]) if i // 9 % 2 else rng.choice(["grobul", "vexaf"]) + rng.choice(["an", "er", "ti"])
                words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), "x"))
        if i % 4:
            labels.append((i, int(toxic), 1))
    return spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


@pytest.fixture(scope="module")
def model(planted):
    return toxicity.fit(*planted)


def test_held_out_rows(planted, model):
    docs, _ = planted
    scores = toxicity.score(docs, model).withColumn("out", held_out(F.col("doc_id"), 4)).collect()
    assert len(scores) == 1500
    held = [(r.score, r.doc_id % 9 == 0) for r in scores if r.out]
    good = sum((s >= 0.3) == t for s, t in held)
    assert good >= 0.97 * len(held)


def test_label_model_knows_good_voters(model):
    rate = dict(zip(model.voters.names, zip(model.label_model.toxic, model.label_model.clean)))
    assert rate["insult"][0] > 0.2 > rate["insult"][1]
    assert 0.05 < model.label_model.prior < 0.2
    mined = set(sum(model.voters.mined, []))
    assert {"grob*", "vexa*"} & mined


def test_correlated_voters_share_weight(spark):
    rng = np.random.default_rng(0)
    toxic = rng.random(4000) < 0.1
    one = (rng.random(4000) < np.where(toxic, 0.7, 0.02)).astype(int)
    lone = (rng.random(4000) < np.where(toxic, 0.7, 0.02)).astype(int)
    said = np.where(rng.random(4000) < 0.3, np.where(toxic, 8, 16), 0)
    masks = one * 3 + lone * 4 + said
    frame = spark.createDataFrame([(int(m),) for m in masks], "votes long")
    fitted = toxicity.fit_label_model(frame, ["a", "copy of a", "lone", *toxicity.ANNOTATORS])
    assert fitted.weights[0] < 0.75 * fitted.weights[2]
    assert fitted.prior == pytest.approx(0.1, abs=0.03)


def test_filter_keeps_columns(planted, model):
    docs, _ = planted
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    gone = 1500 - kept.count()
    assert 130 <= gone <= 190


def test_awkward(awkward, nothing, model, spark):
    scores = toxicity.score(awkward, model).collect()
    assert len(scores) == awkward.count() and all(0 <= r.score <= 1 for r in scores)
    empty = [r.score for r in scores if r.doc_id in (0, 1, 2)]
    assert len(set(empty)) == 1
    assert toxicity.score(nothing, model).collect() == []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for docs in (awkward, nothing):
        blank = toxicity.fit(docs, labels)
        assert all(r.score < 0.5 for r in toxicity.score(docs, blank).collect())
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 5), (3, 1), (3, 0)], "doc_id long, toxic int")
    toxicity.fit(awkward, odd)


def test_label_model_equals_plain_em(spark):
    """Every round against sums over the single documents, without folding or matrices of cells."""
    rng = random.Random(11)
    names = ["a", "b", "c", *toxicity.ANNOTATORS]
    docs = []
    for _ in range(600):
        bad = rng.random() < 0.2
        on = [rng.random() < (p if bad else q) for p, q in ((0.7, 0.02), (0.5, 0.1), (0.4, 0.05))]
        told = rng.random() < 0.4
        docs.append([*on, told and bad, told and not bad])
    m, n = len(names), len(docs)
    rate = [(sum(d[i] for d in docs) + 0.5) / (n + 1) for i in range(m)]
    prior, weights = 0.1, [m**-0.5] * 3 + [1.0, 1.0]
    toxic = [min(max(0.3, 1.5 * r), 0.95) for r in rate[:3]] + [0.97, 0.03]
    clean = [min(max(0.8 * r, 1e-5), 0.9) for r in rate[:3]] + [0.03, 0.97]

    def posterior(d):
        z = np.log(prior / (1 - prior))
        for i in range(m):
            if d[i]:
                z += weights[i] * np.log(toxic[i] / clean[i])
            elif i < 3:
                z += weights[i] * np.log((1 - toxic[i]) / (1 - clean[i]))
        return 1 / (1 + np.exp(-z))

    for _ in range(toxicity.ROUNDS):
        p = [posterior(d) for d in docs]
        sums = {1: max(sum(p), 1.0), 0: max(n - sum(p), 1.0)}
        mass = {1: p, 0: [1 - x for x in p]}
        together = {k: [[sum(w for w, d in zip(mass[k], docs) if d[i] and d[j]) for j in range(m)] for i in range(m)] for k in (0, 1)}
        shared = [0.0] * 3
        for i in range(3):
            for j in range(3):
                if i != j:
                    found = []
                    for k in (0, 1):
                        ri, rj = ((together[k][x][x] + 0.5) / (sums[k] + 1) for x in (i, j))
                        found.append((together[k][i][j] / sums[k] - ri * rj) / (ri * (1 - ri) * rj * (1 - rj)) ** 0.5)
                    shared[i] += min(max(*found, 0), 1)
        # Labels may say either; no other voter is worse than chance.
        on = {k: [min(max((together[k][i][i] + 0.5) / (sums[k] + 1), (1e-5, 1e-4)[k]), 0.99) for i in range(m)] for k in (0, 1)}
        toxic = [max(a, b) for a, b in zip(on[1][:3], on[0])] + on[1][3:]
        clean = [min(a, b) for a, b in zip(on[1][:3], on[0])] + on[0][3:]
        prior, weights[:3] = min(max(sums[1] / n, 0.005), 0.5), [1 / (1 + x) for x in shared]
    masks = [sum(1 << i for i in range(m) if d[i]) for d in docs]
    fitted = toxicity.fit_label_model(spark.createDataFrame([(x,) for x in masks], "votes long"), names)
    assert fitted.prior == pytest.approx(prior, abs=1e-9)
    for got, want in ((fitted.toxic, toxic), (fitted.clean, clean), (fitted.weights, weights)):
        assert got == pytest.approx(np.array(want), abs=1e-9)
    assert fitted.posterior(np.array(masks)) == pytest.approx(np.array([posterior(d) for d in docs]), abs=1e-9)
