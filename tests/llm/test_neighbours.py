"""Recall and order against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import neighbours as nb
from loomstat.llm import queries


def brute(rows, asks, k=20):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if asks(i) and (i not in out or tuple(q) < out[i][0]):
            near = sorted((-float(q @ v), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = (tuple(q), [(j, -s) for s, j in near[:k]])
    return {i: found for i, (_, found) in out.items()}


def check(got, want, least):
    rows = {}
    for r in got:
        rows.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    assert set(rows) <= set(want)
    for q, truth in want.items():
        mine = sorted(rows.get(q, []))
        assert [r[0] for r in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(truth)
        assert mine == sorted(mine, key=lambda r: (-r[2], r[1]))
        hits += (Counter(r[1] for r in mine) & Counter(j for j, _ in truth)).total()
        total += len(truth)
        exact = dict(truth)
        assert all(r[2] == pytest.approx(exact[r[1]], abs=1e-12) for r in mine if r[1] in exact)
    assert hits >= least * total
    return hits / max(total, 1)


@pytest.mark.parametrize("shard,chunk", [(65536, 256), (150, 7)])
def test_recall(spark, monkeypatch, shard, chunk):
    monkeypatch.setattr(nb, "SHARD", shard)
    monkeypatch.setattr(nb, "CHUNK", chunk)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=32) * rng.uniform(0.2, 2)]) for i in range(800)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check(nb.nearest(frame, F.col("vec_id") % 20 == 0).collect(), brute(rows, lambda i: i % 20 == 0), 0.93)


def test_whole_table(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check(queries.op5_nearest_vectors(spark, folder).collect(), brute(rows, lambda i: i % 20 == 0), 0.93)


def test_awkward(spark):
    one = [1.0, 0.0, 0.5]
    rows = [
        (0, one), (20, one), (1, one), (2, one), (2, one), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.5]), (7, [1.0, float("nan"), 0.5]),
        (8, [float("-inf"), 0.0, 0.5]), (9, [3.0, 0.0, 1.0]), (None, one), (40, [1.0, 2.0]), (60, None), (80, [-1.0, 0.0, 0.0]),
    ]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, key string")
    check(nb.nearest(frame, F.col("vec_id") % 20 == 0).collect(), brute(rows, lambda i: i % 20 == 0), 1.0)
    assert nb.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []
