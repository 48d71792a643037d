"""Links and groups against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from loomstat.llm import vector_groups as vg


def brute(rows):
    unit, good = [], []
    for _, v, label in rows:
        ok = label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(ok)
        a = np.array(v, dtype=float) if ok else None
        unit.append(a / np.abs(a).max() / np.linalg.norm(a / np.abs(a).max()) if ok else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n_links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= vg.THRESHOLD:
                n_links[i] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    out = []
    for i, (vec, _, _) in enumerate(rows):
        component = least.get(find(i))
        out.append((vec, n_links[i], component, vec is not None and vec == component))
    return sorted(out, key=repr)


def compare(frame):
    rows = [(r.vec_id, r.embedding, r.label) for r in frame.select("vec_id", "embedding", "label").collect()]
    got = sorted((tuple(r) for r in vg.group_vectors(frame).collect()), key=repr)
    assert got == brute(rows)
    return got


def planted(n=300, groups=12, size=14, seed=3):
    rng = np.random.default_rng(seed)
    vectors = [rng.normal(size=24) for _ in range(n)]
    labels = [int(i) for i in rng.integers(0, 3, n)]
    for g in range(groups):
        for k in range(size):
            v = vectors[g] + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.2, 0.3])
            vectors.append(v * rng.uniform(0.5, 3))
            labels.append(labels[g] if k % 7 else (labels[g] + 1) % 3)
    return [(i, [float(np.float32(x)) for x in v], labels[i]) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("shard,chunk", [(8192, 65536), (64, 50)])
def test_equals_all_pairs(spark, monkeypatch, shard, chunk):
    monkeypatch.setattr(vg, "SHARD", shard)
    monkeypatch.setattr(vg, "CHUNK", chunk)
    got = compare(spark.createDataFrame(planted(), "vec_id long, embedding array<float>, label int"))
    assert max(r[1] for r in got) > 5


def test_awkward(spark):
    one = [1.0, 0.0, 0.5]
    rows = [
        (0, one, 1), (1, one, 1), (2, one, 2), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 0.5], 1),
        (8, [1.0, float("nan"), 0.5], 1), (9, [float("inf"), 0.0, 0.5], 1), (10, [2.0, 0.0, 1.0], 1), (11, [1.0, 0.0], 1), (12, [1e-30, 0.0, 5e-31], 1), (12, one, 1),
        (None, [0.0, 1.0, 0.0], 1), (13, [0.0, -1.0, 0.0], 2),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    got = compare(frame)
    assert len(got) == len(rows)
    assert vg.group_vectors(frame.limit(0)).collect() == []


def test_whole_table(spark, folder):
    compare(spark.read.parquet(f"{folder}/embeddings.parquet"))


def test_one_large_group():
    """Beams widen past a group larger than the first beam."""
    rng = np.random.default_rng(1)
    x = np.concatenate([np.eye(16)[0] + rng.normal(size=(700, 16)) * 0.02, rng.normal(size=(900, 16))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(len(x))
    shard = vg.ShardLinks(ids, np.ones(len(x), dtype=np.int64), rng.random(len(x)), x, vg.THRESHOLD)
    n_links, edges = shard.resolve(ids, x, ids[::50])
    assert (n_links == (x @ x.T >= vg.THRESHOLD).sum(axis=1) - 1).all()
    assert len(edges) == 699


def test_bridged_clusters():
    """Two regions, each denser than a beam, joined by one pair that neither probes nor audits see."""
    rng = np.random.default_rng(5)

    # The centres are 40 degrees apart, so only the bridging vectors at 10 and 30 link across (the cosine of 20 degrees is 0.94).
    def at(degrees, n, spread):
        a = np.radians(degrees)
        x = np.cos(a) * np.eye(32)[0] + np.sin(a) * np.eye(32)[1] + rng.normal(size=(n, 32)) * spread
        return x / np.linalg.norm(x, axis=1)[:, None]

    x = np.concatenate([at(0, 200, 0.012), at(40, 200, 0.012), at(10, 1, 0), at(30, 1, 0), rng.normal(size=(300, 32))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= vg.THRESHOLD
    assert near[400, 401] and not near[:200, 200:400].any() and near[:200, :200].all() and near[400, :200].all() and near[401, 200:400].all()
    ids = np.arange(len(x))
    shard = vg.ShardLinks(ids, np.ones(len(x), dtype=np.int64), rng.random(len(x)), x, vg.THRESHOLD)
    n_links, edges = shard.resolve(ids, x, ids[:100])
    assert (n_links == near.sum(axis=1) - 1).all()
    assert len(edges) == 401


def test_sparse_pairs():
    """All pairs of a full shard are found although few queries have a link and the rest lie just below the threshold."""
    rng = np.random.default_rng(7)
    g = rng.normal(size=(vg.SHARD, 256))
    g /= np.linalg.norm(g, axis=1)[:, None]
    g[-32:] = 0.6 * g[:32] + 0.8 * g[-32:]
    x = np.eye(256)[0] + 0.38 * g
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (x @ x.T >= vg.THRESHOLD).sum(axis=1) - 1
    assert (want > 0).sum() == 64 and want.max() == 1
    ids, draws = np.arange(len(x)), np.random.default_rng(8).random(len(x))
    # None of the pairs is above ground.
    draws[want > 0] = 0.5
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(["k"] * 2 * len(x)), pa.array(np.repeat([0, 1], len(x))), pa.array(np.tile(ids, 2)), pa.array(np.ones(2 * len(x), dtype=np.int64)),
            pa.array(np.tile(draws, 2)), pa.array(np.tile(np.random.default_rng(9).permutation(len(x)), 2)), pa.array([*x, *x], pa.list_(pa.float64())),
        ],
        ["key", "query", "node", "copies", "draw", "audit", "unit"],
    )
    got = np.zeros(len(x), dtype=np.int64)
    for out in vg.shard_links(iter([batch])):
        np.add.at(got, out.column(0).to_numpy(), out.column(1).to_numpy())
    assert (got == want).all()


def test_missed_link_means_all_pairs(monkeypatch):
    """A search that an audited query shows to miss a link is not used."""
    monkeypatch.setattr(vg, "AUDITS", 20)
    monkeypatch.setattr(vg, "AUDIT_LINKED", 20)
    monkeypatch.setattr(vg, "BATCH", 20)
    monkeypatch.setattr(vg.ShardLinks, "groups", lambda self, ids, queries, width: (np.zeros(len(ids), dtype=np.int64), []))
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(100, 16)), 2, axis=0) + rng.normal(size=(200, 16)) * 0.01
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(200)
    n_links, edges = vg.ShardLinks(ids, np.ones(200, dtype=np.int64), rng.random(200), x, vg.THRESHOLD).resolve(ids, x, rng.permutation(200))
    assert (n_links == (x @ x.T >= vg.THRESHOLD).sum(axis=1) - 1).all() and len(edges) == 100
