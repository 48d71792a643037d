"""The alignment equals a plain one that tokenises every whole text with both public libraries."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from loomstat.llm import alignment, common
from loomstat.llm.queries import BYTE_MODEL, PIECE_MODEL, op12_tokenizer_alignment


@pytest.fixture(scope="module")
def models():
    with open(BYTE_MODEL, "rb") as a, open(PIECE_MODEL, "rb") as b:
        return a.read(), b.read()


def plain(rows, models):
    first = Tokenizer.from_str(models[0].decode())
    first.encode_special_tokens = True
    letters = alignment.byte_letters()
    second = sentencepiece.SentencePieceProcessor(model_proto=models[1])

    def bytes_of(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    linked, out = {}, []
    for n, (doc_id, text) in enumerate(rows):
        raw = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_raw = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        b_raw = [bytes_of(i) for i in b]
        if b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            a, b = [], []
        groups, links, i, j, i_end, j_end = [([], [])], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if i_end <= j_end:
                i_end += len(a_raw[i])
                groups[-1][0].append(a[i])
                i += 1
            else:
                j_end += len(b_raw[j])
                groups[-1][1].append(b[j])
                j += 1
            if i_end == j_end:
                links.append((a[i - 1], b[j - 1]))
                groups.append(([], []))
        groups.pop()
        linked[n] = links
        digest = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), hashlib.sha256(digest.encode()).hexdigest() if a else ""))
    counts = Counter(pair for links in linked.values() for pair in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (*row[:5], sum(counts[p] == highest[p[1]] for p in linked[n]), sum(counts[p] for p in linked[n]), row[5]) for n, row in enumerate(out)
    ]


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


def test_awkward_texts(awkward, make_docs, models, monkeypatch):
    more = ["visible ▁ space", "<|endoftext|> <s> </s> <unk> <0x41>", "  two  spaces ", " a\nb\tc \n d", "中文 字符。 ok", "don't we'll 's", "tab nbsp x\u0085y z\x1cq", "a" * 3000, "\U0001fae8 new \U00011f02 letter"]
    docs = awkward.unionByName(make_docs(more, doc_id=[1000 + i for i in range(len(more))]))
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 20_000)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert by_id(alignment.align_tokenizers(docs, *models).collect()) == by_id(plain(rows, models))


def test_hot_text(make_docs, models):
    texts = ["one text that a third of all documents hold"] * 20 + [f"text {i} of its own" for i in range(40)]
    docs = make_docs(texts)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert by_id(alignment.align_tokenizers(docs, *models).collect()) == by_id(plain(rows, models))


def test_empty_table(nothing, models):
    out = alignment.align_tokenizers(nothing, *models)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.count() == 0


def test_bundles_equal_single_parts(models, monkeypatch):
    parts = [f"word{i % 7},x" for i in range(20)] + ["x" * 100, "a▁b", "\n", " lead", "trail\t", "字。", "a\nb", "it's"]
    aligner = alignment.Aligner(*models)
    bundled = aligner.align(parts)
    monkeypatch.setattr(alignment, "BUNDLE", 1)
    single = aligner.align(parts)
    assert bundled.digests == single.digests and bundled.digests[21] is None
    for name in ("n_a", "n_b", "links", "codes"):
        assert getattr(bundled, name).tolist() == getattr(single, name).tolist()


@pytest.mark.parametrize("text", ["a b", " a b", "a  b", "a \nb c", "a\n b", "a b ", "a\tb c", "a\t b", "a\u00a0 b c", "\n", " ", "a\nb c\n"])
def test_parts_are_those_of_the_pattern(text):
    assert alignment.parts_of(text) == alignment.CUT.split(text)
    assert " ".join(alignment.parts_of(text)) == text


def test_whole_table(spark, folder, models):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert by_id(op12_tokenizer_alignment(spark, folder).collect()) == by_id(plain(rows, models))


@pytest.mark.parametrize("share", [2, 5, 1000])
def test_attach_by_key(spark, monkeypatch, share):
    """Hot, seldom, missing and unmatched keys, whatever counts as hot."""
    monkeypatch.setattr(common, "HOT_SHARE", share)
    keys = ["hot"] * 30 + ["warm"] * 8 + [f"k{i}" for i in range(10)] + [None] * 6 + ["absent"] * 2
    rows = spark.createDataFrame(list(enumerate(keys)), "doc_id long, key string").repartition(3)
    table = spark.createDataFrame([("hot", 1), ("warm", 2), ("unused", 3), *[(f"k{i}", 10 + i) for i in range(10)]], "key string, v long")
    value = {r.key: r.v for r in table.collect()}
    got = sorted((r.doc_id, r.key, r.v) for r in common.attach_by_key(rows, table, "key").collect())
    assert [r[0] for r in got] == list(range(len(keys)))
    assert [r[2] for r in got] == [value.get(k) for k in keys]


def test_hot_and_seldom_texts(make_docs, models, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 4)
    texts = ["one text that a third of all documents hold"] * 20 + ["another twice"] * 2 + [f"text {i} of its own" for i in range(30)] + [None, ""]
    docs = make_docs(texts)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert by_id(alignment.align_tokenizers(docs, *models).collect()) == by_id(plain(rows, models))
