"""Targets, copies and emission against a plain Python reading of the rules."""

import hashlib
import re

import pytest

from loomstat.llm import mixing


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    capped = set()
    while True:
        open_weight = sum(weight[s] for s in order if s not in capped)
        left = total - sum(most * sizes[s] for s in capped)
        more = {s for s in order if s not in capped and left / open_weight * weight[s] > most * sizes[s]} if open_weight else set()
        if not more:
            return {s: most * sizes[s] if s in capped else left / open_weight * weight[s] for s in order}
        capped |= more


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for _, text, _ in rows]
    sizes = {}
    for n, (_, _, source) in zip(size, rows):
        sizes[source] = sizes.get(source, 0) + n
    target = fill(sizes)
    out = []
    for n, (doc, _, source) in zip(size, rows):
        rate = target[source] / sizes[source] if sizes[source] else 0.0
        text = f"mix:{'null' if doc is None else doc}"
        draw = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
        copies = int(rate) + (draw < rate - int(rate))
        out.append((doc, n, sizes[source], target[source], n * copies, copies))
    return sorted(out, key=repr)


def compare(docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = sorted((tuple(r) for r in mixing.mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken", "copies").collect()), key=repr)
    want = brute(rows)
    assert [(g[0], g[1], g[2], g[4], g[5]) for g in got] == [(w[0], w[1], w[2], w[4], w[5]) for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    return got


def test_many_sources(make_docs):
    texts = [" ".join(["w"] * (1 + i * 7 % 50)) for i in range(900)]
    sources = [None if i % 40 == 0 else f"site{min(i % 40, i % 7 * 3)}é" if i % 3 else "hot" for i in range(900)]
    docs = make_docs(texts, source=sources)
    got = compare(docs)
    taken, target = {}, {}
    for doc, size, source_size, goal, used, copies in got:
        assert copies <= 2
        taken[goal] = taken.get(goal, 0) + used
        target[goal] = goal
    assert sum(taken.values()) == pytest.approx(1.5 * sum(len(t.split()) for t in texts), rel=0.1)


def test_emission_and_reruns(make_docs):
    docs = make_docs([f"a b c {i}" for i in range(200)])
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(docs).collect()}
    for parts in (1, 7):
        mixed = mixing.mix_sources(docs.repartition(parts))
        assert mixed.columns == docs.columns
        counts = {}
        for r in mixed.collect():
            assert r.text == f"a b c {r.doc_id}" and r.key == "k" and r.size == 7
            counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
        assert counts == {d: c for d, c in plan.items() if c}


def test_awkward(awkward, nothing, make_docs):
    compare(awkward)
    compare(make_docs([None, "", " "]))
    assert mixing.mix_plan(nothing).collect() == [] and mixing.mix_sources(nothing).collect() == []
