"""Factorisation over strips: equal to plain matrices, whatever the strips; files do not pile up."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.operators import factors, topics
from loomstat.session import cut_lineage, release, shared_root


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(4)
    v = rng.poisson(0.6, size=(30, 17)) * rng.random((30, 17))
    rows = [(f"d{i}", f"t{j}", float(v[i, j])) for i in range(30) for j in range(17) if v[i, j] > 0]
    return spark.createDataFrame(rows, "id string, term string, tfidf double").repartition(3), v


def plain(v, rounds, kl, l1, l2):
    keep_d, keep_t = v.sum(axis=1) > 0, v.sum(axis=0) > 0
    w = np.array([[1.0 + len(f"d{i}") % 2, 1.0 + i % 3] for i in range(len(v))])[keep_d]
    h = np.array([[1.0 + j % 4, 2.0] for j in range(v.shape[1])])[keep_t].T
    v = v[keep_d][:, keep_t]
    for _ in range(rounds):
        for own in ("w", "h"):
            r = np.where(v > 0, v / (w @ h + 1e-12), 0) if kl else v
            if own == "w":
                w = w * (r @ h.T) / ((h.sum(axis=1) if kl else w @ h @ h.T) + l1 + l2 * w + 1e-12)
            else:
                h = h * (w.T @ r) / ((w.sum(axis=0)[:, None] if kl else w.T @ w @ h) + l1 + l2 * h + 1e-12)
    return w, h


@pytest.mark.parametrize("kl", [False, True])
@pytest.mark.parametrize("rounds", [1, 3])
def test_rounds_equal_plain_matrices(cells, kl, rounds):
    df, v = cells
    number = F.substring("doc", 2, 9).cast("int")
    start = ([1.0 + F.length("doc") % 2, 1.0 + number % 3], [1.0 + F.substring("term", 2, 9).cast("int") % 4, F.lit(2.0)])
    fit = topics.topics_nmf_kl if kl else topics.topics_nmf
    found = fit(df, "id", 2, max_iter=rounds, tol=0.0, start=start)
    w, h = plain(v, rounds, kl, 0.05, 0.05)
    docs = {r.id: r.weights for r in found.docs.collect()}
    keep = [i for i in range(len(v)) if v[i].sum() > 0]
    np.testing.assert_allclose([docs[f"d{i}"] for i in keep], w, rtol=1e-9)
    terms = {(r.topic, r.term): r.weight for r in found.terms.collect()}
    kept = [j for j in range(v.shape[1]) if v[:, j].sum() > 0]
    np.testing.assert_allclose([[terms[k, f"t{j}"] for j in kept] for k in (0, 1)], h, rtol=1e-9)


def folder_mb(spark):
    root = shared_root(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)


def test_files_do_not_pile_up(spark, cells):
    df, _ = cells

    def grown(rounds):
        before = folder_mb(spark)
        topics.topics_nmf_kl(df, "id", 2, max_iter=rounds, tol=0.0)
        return folder_mb(spark) - before

    few, many = grown(2), grown(7)
    assert many < 1.5 * few


def test_release_deletes_what_was_stored(spark):
    before = folder_mb(spark)
    stored = cut_lineage(spark.range(1000))
    assert folder_mb(spark) > before
    release(stored)
    assert folder_mb(spark) == before


def test_tables_without_cells(spark):
    none = spark.createDataFrame([(1, "a", 0.0)], "id long, term string, tfidf double")
    found = topics.topics_nmf_kl(none, "id", 2)
    assert found.docs.columns == ["id", "weights"] and found.docs.count() == 0 and found.terms.count() == 0
    one = spark.createDataFrame([(1, "a", 2.0)], "id long, term string, tfidf double")
    found = topics.topics_nmf(one, "id", 1, alpha=0.0)
    w, h = found.docs.first().weights[0], found.terms.first().weight
    assert w * h == pytest.approx(2.0, rel=1e-3)


def test_strips_are_many_where_cells_are(spark, cells, monkeypatch):
    df, _ = cells
    whole = topics.topics_nmf_kl(df, "id", 2, max_iter=3)
    monkeypatch.setattr(factors, "STRIP_CELLS", 5)
    cut = topics.topics_nmf_kl(df, "id", 2, max_iter=3)
    assert whole.info["losses"] == pytest.approx(cut.info["losses"], rel=1e-9)


def test_svd_ends_with_small_residuals_or_an_error(spark, cells):
    df, v = cells
    found = topics.topics_svd(df, "id", 3, value="tfidf", extra=2)
    kept = v[v.sum(axis=1) > 0][:, v.sum(axis=0) > 0]
    np.testing.assert_allclose(found.info["singular_values"], np.linalg.svd(kept, compute_uv=False)[:3], rtol=1e-9)
    assert max(found.info["residuals"]) <= 1e-6
    scores = np.array([r.weights for r in found.docs.collect()])
    np.testing.assert_allclose(np.sqrt((scores**2).sum(axis=0)), found.info["singular_values"], rtol=1e-9)
    with pytest.raises(RuntimeError, match="after 2 rounds"):
        topics.topics_svd(df, "id", 3, value="tfidf", extra=0, rounds=2)
    assert len(topics.topics_svd(df, "id", 3, value="tfidf", rounds=2, tol=0.0).info["singular_values"]) == 3


def test_svd_of_a_table_of_low_rank(spark):
    rows = [(i, f"t{j}", float((i + 1) * (j + 1))) for i in range(6) for j in range(4)]
    found = topics.topics_svd(spark.createDataFrame(rows, "id long, term string, value double"), "id", 3)
    want = np.sqrt(sum((i + 1) ** 2 for i in range(6)) * sum((j + 1) ** 2 for j in range(4)))
    assert found.info["singular_values"][0] == pytest.approx(want) and found.info["singular_values"][1] < 1e-5 * want
