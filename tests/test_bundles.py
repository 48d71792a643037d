"""Bundles keep every cell, send a row a block, and a wide factor by slices is the same; counts with small statistics stay where they are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.operators import bundles, terms, topics


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(6)
    rows = [(i if i else None, f"t{j}", float(rng.integers(1, 6)) * (0.37 + j)) for i in range(24) for j in range(14) if rng.random() < 0.6]
    return spark.createDataFrame(rows, "id long, term string, value double").repartition(3)


@pytest.mark.parametrize("v", [[1.5, 3.0, 0.7, 2.1], [0.0, -2.0, float("nan"), 1e300]])
def test_coded_cells_come_back_as_they_were(v):
    first, t, at = np.array([0, 1, 4]), np.array([0, 0, 1, 1]), np.array([7, 3])
    got = bundles.decoded(bundles.coded(first, t, at, np.array(v)))
    for a, b in zip(got, (first, t, at, np.array(v))):
        np.testing.assert_array_equal(a, b)
    many = bundles.coded(np.arange(0, 100_001, 100), np.tile(np.arange(100), 1000), np.arange(100), np.tile(np.arange(1, 101) * 0.3, 1000))
    assert len(many) < 4 * 100_000


def test_bundles_hold_every_cell_once(spark, cells, monkeypatch):
    monkeypatch.setattr(bundles, "BUNDLE_TERMS", 5)
    long = cells.withColumnRenamed("id", "doc").withColumnRenamed("value", "v")
    packed = bundles.Bundles(long, 2, 8, F.pmod(F.coalesce("doc", F.lit(0)), F.lit(2)).cast("int"))
    words = {(r.block, i): t for r in packed.vocabulary.collect() for i, t in enumerate(r.terms)}
    assert len(words) == packed.n_terms == len(set(words.values()))
    place = {}
    for r in packed.links.collect():
        for at, idx in zip(np.frombuffer(r.at, "<i4"), np.frombuffer(r.idx, "<i4")):
            place[r.bundle, int(at)] = words[r.block, int(idx)]
    found = []
    for r in packed.rows.collect():
        first, t, at, v = bundles.decoded(bytes(r.cells))
        assert {(d or 0) % 2 for d in r.docs} == {r.batch}
        found += [(r.docs[i], place[r.bundle, int(at[t[c]])], float(v[c])) for i in range(len(r.docs)) for c in range(first[i], first[i + 1])]
    assert sorted(found, key=str) == sorted(((r.doc, r.term, r.v) for r in long.collect()), key=str)
    assert packed.n_docs == len({r.doc for r in long.collect()})
    packed.release()


def test_a_pass_sends_a_row_a_block_and_bundle(spark, cells):
    """A row a term and strip was sent before."""
    packed = bundles.Bundles(cells.withColumnRenamed("id", "doc").withColumnRenamed("value", "v"), 1, 8)
    factor = packed.factor([F.lit(1.0)], lambda h: h.sum(axis=0))
    assert bundles.own_sum(factor)[0] == packed.n_terms
    back = packed.passed(factor, 1, lambda b: b.sent(b.table), bundles.ADDS)
    assert back.count() == packed.links.count() <= packed.rows.select("bundle").distinct().count() * packed.vocabulary.count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "cells" in plan and plan.count("Exchange hashpartitioning(bundle") == 1
    packed.release()


def test_slices_of_a_wide_factor_give_the_same(spark, cells, monkeypatch):
    def values():
        found = topics.topics_svd(cells, "id", 3, rounds=2, tol=0.0)
        return found.info["singular_values"], {(r.id, i): w for r in found.docs.collect() for i, w in enumerate(r.weights)}

    whole, docs = values()
    monkeypatch.setattr(topics, "SLICE", 4)
    cut, again = values()
    np.testing.assert_allclose(cut, whole, rtol=1e-9)
    np.testing.assert_allclose([again[k] for k in docs], list(docs.values()), rtol=1e-6, atol=1e-9)


def test_small_statistics_leave_counts_where_they_are(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 20, f"a b{'xyz'[i % 3]} a") for i in range(40)], "id long, text string").repartition(8)
    counts = terms.doc_term(terms.tokenize(docs, "id", together=True), "id")
    kept = terms.limit_terms(counts, "id", 20, 1, 1.0)
    assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(terms, "STATS_ROWS", 0)
    by_term = [terms.limit_terms(counts, "id", 20, 1, 1.0)]
    monkeypatch.setattr(terms, "TERM_ROWS", 3)
    by_term.append(terms.limit_terms(counts, "id", 20, 1, 1.0))
    order = ["id", "term"]
    columns = ["id", "term", "tf", "total", "df"]
    for other in by_term:
        assert other.select(columns).orderBy(order).collect() == kept.select(columns).orderBy(order).collect()


def test_text_clusters_do_not_store_the_long_table(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{'red blue' if i % 2 else 'oak elm'} w{'abc'[i % 3]}") for i in range(24)], "id long, text string")
    stored, cut_lineage = [], topics.cut_lineage
    monkeypatch.setattr(topics, "cut_lineage", lambda df, **how: (stored.append(df.columns), cut_lineage(df, **how))[1])
    found = topics.text_clusters_em(docs, "id", k=2, min_df=1, dims=2, n_terms=2, max_iter=2)
    assert ["id", "term", "value"] not in stored
    assert found.terms.count() == 4 and found.docs.count() == 24
