"""Groups against all pairs."""

import numpy as np
import xxhash

from loomstat.llm import simhash


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    values = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_groups(rows):
    prints = np.array([plain_fingerprint(t) for _, t in rows], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(prints ^ prints[i]) <= 3)[0]:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], f"{int(prints[i]):016x}", least[find(i)]) for i in range(len(rows))), key=repr)


def compare(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in simhash.group_near_duplicates(docs).collect()), key=repr)
    assert got == brute_groups(rows)
    return got


def test_awkward(awkward, nothing):
    got = compare(awkward)
    assert (None, got[-1][1], None) in got or any(r[0] is None for r in got)
    assert simhash.group_near_duplicates(nothing).collect() == []


def test_whole_table(spark, folder):
    got = compare(spark.read.parquet(f"{folder}/documents.parquet"))
    assert any(doc != group for doc, _, group in got)


def test_planted_fingerprints(spark, monkeypatch):
    """Chains of links, and posting lists cut into blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, 12, dtype=np.int64).view(np.uint64)
    prints = [int(c) for c in centre]
    for c in centre:
        now = int(c)
        for _ in range(30):
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                now ^= 1 << int(b)
            prints.append(now)
    prints = np.unique(np.array(prints, dtype=np.uint64))
    rows = [(int(p.view(np.int64)), i) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "fp long, node long")
    forest = simhash.Forest()
    for r in simhash.candidate_links(nodes).collect():
        assert np.bitwise_count(prints[r.a] ^ prints[r.b]) <= 3
        forest.union(r.a, r.b)
    want = simhash.Forest()
    for i in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(prints ^ prints[i]) <= 3)[0]:
            want.union(i, int(j))
    assert [forest.root(i) for i in range(len(prints))] == [want.root(i) for i in range(len(prints))]


def test_one_stays(make_docs):
    body = " ".join(f"w{i}" for i in range(400))
    docs = make_docs([body, body.upper(), body, "something else entirely here", ""])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]
