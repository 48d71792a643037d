"""Spelling variants equal those of a plain search through all pairs of words."""

import re
import zlib
from collections import Counter

import pytest

from loomstat.llm import spelling
from loomstat.llm.queries import op11_spelling_variants

DOWN = str.maketrans(spelling.UPPER, spelling.LOWER)


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(DOWN)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(word, alphabet):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet} | {a + c + b[1:] for a, b in cuts if b for c in alphabet}
    return out - {word}


def plain(rows):
    counts = words_of(rows)
    alphabet = {c for w in counts for c in w}
    found = {}
    for word, n in counts.items():
        near = [w for w in one_edit(word, alphabet) if w in counts]
        form = min(near, key=lambda w: (-counts[w], w), default=None)
        found[word] = (form if form and counts[form] >= 5 * n else None, n, len(near))
    out = []
    for word, (form, n, n_near) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        out.append((word, form, root, n, n_near, found[form][1] if form else None))
    return sorted(out, key=lambda r: r[0])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[0])


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_awkward_texts(awkward):
    assert rows_of(spelling.group_variants(awkward)) == plain(texts_of(awkward))


def test_chains_and_ties(make_docs):
    words = ["government "] * 700 + ["goverment "] * 130 + ["govermant "] * 26 + ["covermant "] * 5 + ["strasse straße "] * 6 + ["strassen strassem "] * 40 + ["ÉTUDES études etudes "] * 9
    docs = make_docs(["".join(words[i::7]) for i in range(7)])
    rows = rows_of(spelling.group_variants(docs))
    assert rows == plain(texts_of(docs))
    by = {r[0]: r for r in rows}
    assert by["covermant"][1:3] == ("govermant", "government")
    assert by["strasse"][1] == "strassem"  # of two equally frequent near words the first in order


@pytest.mark.parametrize("length", [6, 7, 12])
def test_every_single_edit_meets(spark, length):
    word = "abcdefghijklmnopqrstuvwxyz"[:length]
    others = [w for w in one_edit(word, "aqzéÿ") if len(w) >= 6]
    words = spark.createDataFrame([(w, 5) for w in [word, *others]], "word string, n long")
    found = {r.near for r in spelling.near_pairs(words).where(f"word = '{word}'").collect()}
    assert found == set(others)


def test_short_words_meet_without_ends(spark):
    words = spark.createDataFrame([(w, 5) for w in ["a", "b", "ab", "ba", "abc"]], "word string, n long")
    found = {(r.word, r.near) for r in spelling.near_pairs(words, least_letters=1).collect()}
    want = {(a, b) for a, b in [("a", "b"), ("a", "ab"), ("b", "ab"), ("a", "ba"), ("b", "ba"), ("ab", "abc")]}
    assert found == want | {(b, a) for a, b in want}


def test_empty_table(nothing):
    out = spelling.group_variants(nothing)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert out.count() == 0


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert rows_of(op11_spelling_variants(spark, folder)) == plain(texts_of(docs))
