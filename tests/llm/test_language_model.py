"""Scores against a plain automaton over dictionaries."""

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from loomstat.llm import language_model as lm
from loomstat.llm import queries


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "</s>"]


def brute(rows, order):
    held = {i: crc32(str(d).encode() if d is not None else b"") % 7 == 2 for i, (d, _) in enumerate(rows)}
    grams = [Counter() for _ in range(order)]
    for i, (_, text) in enumerate(rows):
        if not held[i]:
            seq = ["<s>", *tokens_of(text)]
            for end in range(len(seq)):
                for n in range(1, order + 1):
                    if end - n + 1 >= 0:
                        grams[n - 1][tuple(seq[end - n + 1 : end + 1])] += 1
    words = {g: c for g, c in grams[0].items() if g != ("<s>",)}
    total, distinct = sum(words.values()), len(words)
    steps = [lm.discounts([sum(c == k for c in g.values()) for k in (1, 2, 3, 4)]) for g in grams]
    followers = [defaultdict(list) for _ in range(order)]
    for n in range(1, order):
        for gram, c in grams[n].items():
            followers[n][gram[:-1]].append(c)

    def probability(history, word):
        n = len(history)
        if not n:
            return (words.get((word,), 0) + 1) / (total + distinct + 1)
        lower = probability(history[1:], word)
        seen = grams[n - 1].get(history, 0)
        if not seen or not followers[n][history]:
            return lower
        c = grams[n].get((*history, word), 0)
        left = sum(steps[n][min(f, 3)] for f in followers[n][history]) / seen
        return max(c - steps[n][min(c, 3)], 0) / seen + left * lower

    out = []
    for i, (doc, text) in enumerate(rows):
        seq = ["<s>", *tokens_of(text)]
        score = sum(math.log10(probability(tuple(seq[max(0, j - order + 1) : j]), seq[j])) for j in range(1, len(seq)))
        base = sum(math.log10(probability((), w)) for w in seq[1:])
        out.append((doc, held[i], len(seq) - 1, sum((w,) in words for w in seq[1:]), total, base, score))
    return out, probability, words


def same(got, want):
    got, want = (sorted(r, key=lambda x: repr(x[:3])) for r in (got, want))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, folder, order):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in lm.score_documents(docs, order=order, group_tokens=3000, bucket_tokens=5000).collect()]
    want, probability, words = brute(rows, order)
    same(got, want)
    for history in ((), ("<s>",)[: order - 1], ("the",)[: order - 1], ("of", "the")[: order - 1]):
        assert sum(probability(history, w) for (w,) in words) + probability(history, "\nnew") == pytest.approx(1)


def test_awkward(awkward, nothing):
    small = awkward.where("text is null or length(text) < 1000")
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    same([tuple(r) for r in lm.score_documents(small, group_tokens=20).collect()], brute(rows, 2)[0])
    assert len(lm.score_documents(awkward).collect()) == awkward.count()
    assert lm.score_documents(nothing).collect() == []


def test_no_training_document(make_docs):
    held = [i for i in range(60) if crc32(str(i).encode()) % 7 == 2][:3]
    rows = lm.score_documents(make_docs(["a b", None, "a"], doc_id=held)).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.score == r.base_score == 0 for r in rows)


def test_query_beats_its_base(spark, folder):
    rows = queries.op6_backoff_scores(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)
