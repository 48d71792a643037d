"""Stochastic topic updates equal plain ones in NumPy and end near the fit that reads all documents at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.operators import topics


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(9)
    sides = [["apple", "pear", "plum", "fig"], ["iron", "zinc", "lead", "tin"]]
    rows = []
    for i in range(48):
        for term in [*sides[i % 2], "common"]:
            n = int(rng.integers(1, 6)) if rng.random() < 0.8 else 0
            if n:
                rows.append((i, term, float(n)))
    return spark.createDataFrame(rows, "id long, term string, value double").repartition(3)


def starts(spark, terms, k, seed):
    table = spark.createDataFrame([(t,) for t in terms], "term string").select("term", *topics._start("term", "h", k, seed, 1.0))
    rows = {r["term"]: [r[f"h{j}"] for j in range(k)] for r in table.collect()}
    return np.array([rows[t] for t in terms])


def expectation(matrix, lam, prior):
    digamma = topics._digamma
    beta = np.exp(digamma(lam) - digamma(lam.sum(axis=0)))
    stats, shares = np.zeros_like(lam), []
    for v in matrix:
        on = v > 0
        gamma = np.full(lam.shape[1], prior + v.sum() / lam.shape[1])
        for _ in range(100):
            theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
            before, gamma = gamma, prior + theta * ((v[on] / (beta[on] @ theta + topics.TINY)) @ beta[on])
            if np.abs(gamma - before).mean() < 1e-3:
                break
        theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
        stats[on] += theta * beta[on] * (v[on] / (beta[on] @ theta + topics.TINY))[:, None]
        shares.append(gamma / gamma.sum())
    return stats, np.array(shares)


def test_updates_equal_plain_ones(spark, planted):
    terms = sorted({r.term for r in planted.collect()})
    matrix = np.zeros((48, len(terms)))
    for r in planted.collect():
        matrix[r.id, terms.index(r.term)] = r.value
    part = {r.id: r.b for r in planted.select("id", F.pmod(F.xxhash64("id", F.lit(12345)), F.lit(3)).alias("b")).distinct().collect()}
    lam, step = starts(spark, terms, 2, 12345), 0
    for _ in range(2):
        for b in range(3):
            step += 1
            own = [i for i in range(48) if part[i] == b]
            stats, _ = expectation(matrix[own], lam, 0.5)
            rate = (10.0 + step) ** -0.7
            lam = (1 - rate) * lam + rate * (0.5 + 48 / len(own) * stats)
    found = topics.topics_lda(planted, "id", 2, max_iter=2, batches=3)
    shares = {r.id: r.weights for r in found.docs.collect()}
    np.testing.assert_allclose([shares[i] for i in range(48)], expectation(matrix, lam, 0.5)[1], rtol=1e-6)
    weights = {(r.term, r.topic): r.weight for r in found.terms.collect()}
    np.testing.assert_allclose([[weights[t, j] for j in (0, 1)] for t in terms], lam / lam.sum(axis=0), rtol=1e-6)


def test_online_and_whole_fits_agree(planted):
    whole = topics.topics_lda(planted, "id", 2, max_iter=20)
    online = topics.topics_lda(planted, "id", 2, max_iter=8, batches=4)
    for fit in (whole, online):
        sides = {}
        for r in topics.topic_assign(fit.docs, "id").collect():
            sides.setdefault(r.id % 2, set()).add(r.topic)
        assert all(len(s) == 1 for s in sides.values()) and sides[0] != sides[1]


def test_more_batches_than_documents(planted):
    few = planted.where("id < 2")
    assert topics.topics_lda(few, "id", 2, max_iter=1, batches=10).docs.count() == 2
