"""Cut lines against a plain Python reading of the rules."""

from collections import defaultdict

import pytest

from loomstat.llm import line_spread


def brute(rows, sites):
    """rows: (doc_id, text, source); equal (doc_id, text) are one document."""
    where, first = defaultdict(set), {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc, text, source in order:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                where[line].add(source)
                first.setdefault(line, doc)
    out = []
    for doc, text, source in rows:
        if text is None:
            out.append((doc, None))
            continue
        seen, kept = set(), []
        for line in text.split("\n"):
            spread = len(where.get(line, ())) >= sites
            stays = not spread or (first[line] == doc and line not in seen)
            seen.add(line)
            if stays:
                kept.append(line)
        out.append((doc, "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(make_docs):
    menu, foot, local = "Home | About", "All rights reserved", "only here"
    texts = []
    for i in range(60):
        texts.append("\n".join([menu, f"own line {i}", foot if i % 3 else "", local if i < 9 else "", menu, f"pair {i // 2}", " "]))
    texts += [None, "", menu, "\n\n", f"{foot}\n{foot}"]
    return make_docs(texts, source=[f"site{i % 9}" if i % 11 else None for i in range(65)], doc_id=[*range(63), None, None])


@pytest.mark.parametrize("sites", [2, 3, 5, 9])
def test_equals_brute_force(docs, sites):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = line_spread.cut_spread_lines(docs, sites=sites, count="n_cut")
    assert got.columns == [*docs.columns, "n_cut"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, sites)


def test_many_sites_use_the_sketch(spark):
    """Far above the threshold the sketch decides, near it the exact count does."""
    rows = [(i, f"everywhere\nfive {i % 7}\nlone {i}", f"s{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for sites in (57, 58, 200):
        got = sorted((r.doc_id, r.text) for r in line_spread.cut_spread_lines(docs, sites=sites).collect())
        assert got == sorted(brute(rows, sites))


def test_awkward(awkward, nothing):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    got = line_spread.cut_spread_lines(awkward, sites=2)
    assert got.columns == awkward.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, 2)
    assert line_spread.cut_spread_lines(nothing).collect() == []


def test_text_of_many_repeated_lines(spark):
    """A text of 100,000 lines, most of them cut, one of them repeated: time grows with the lines, not with their square."""
    long = "\n".join("again" if i % 2 else f"own {i}" for i in range(100_000))
    rows = [(9, long, "a"), *[(10 + i, "again\nown 4\nlast", f"s{i}") for i in range(5)], (3, "again\nagain\nx", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.text) for r in line_spread.cut_spread_lines(docs, sites=5).collect())
    assert got == sorted(brute(rows, 5))


def test_lines_beyond_broadcast_size(docs, monkeypatch):
    """The lookups by salted hot keys instead of by broadcast give the same rows."""
    monkeypatch.setattr("loomstat.operators.joins.fits_broadcast", lambda table: False)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = line_spread.cut_spread_lines(docs, sites=3)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, 3)
