"""Paths against the library's own encoder, and round trips."""

import random

import pytest

from loomstat.llm import pieces, queries

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = [
    "", " ", "a", " a", "a ", "  two  spaces  ", "tab\tline\n\nend", "😀é漢字 ñ ▁x ▁▁", "http://www.example.com/foo?bar=baz&x=1 int main(void) { return 0; }",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "The internationalization of unbelievable misunderstandings", "� ​ zero",
]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(queries.PIECE_MODEL)


def as_unigram(model):
    """The same vocabulary with the model kind set to unigram: no training, one field changed."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    message = proto.ModelProto()
    message.ParseFromString(model)
    message.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    return message.SerializeToString()


def corpus(spark, folder, n=None):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    return [r.text for r in rows][:n] + TEXTS


def test_merge_model_equals_library(spark, folder, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    machine = pieces.PieceTransducer(model)
    for text in corpus(spark, folder):
        ids = machine.encode(text).tolist()
        assert ids == library.encode(text)
        assert machine.decode(ids) == library.decode(ids) == text.replace("▁", " ")


def test_paths_and_cuts_equal_merging(model):
    """On random strings of piece beginnings and ends the one accepted path is what merging by rank gives."""
    rng = random.Random(5)
    machine = pieces.PieceTransducer(model)
    names = sorted(machine.arcs)
    for _ in range(3000):
        text = "".join(rng.choice(names)[: rng.randint(1, 4)] + rng.choice(["", "", "\n", "é", rng.choice(names)[-2:]]) for _ in range(rng.randint(1, 5)))
        want = [tree[0] for tree in machine.merged(text)]
        assert [text[low:high] for low, high, _ in machine.accepted(text)] == want
        parts = machine.cut(text)
        assert "".join(parts) == text
        assert [text for part in parts for text in (part[low:high] for low, high, _ in machine.accepted(part))] == want


def test_unigram_model_has_least_weight(spark, folder, model):
    changed = as_unigram(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=changed)
    machine = pieces.PieceTransducer(changed)
    for text in corpus(spark, folder, 40):
        got, want = machine.encode(text).tolist(), library.encode(text)
        # The library adds single-precision scores, so its path may be a little heavier.
        ours, theirs = (sum(library.get_score(i) for i in ids) for ids in (got, want))
        assert theirs <= ours <= theirs + 1e-3 * abs(theirs)
        assert machine.decode(got) == text.replace("▁", " ")


def test_operator(awkward, nothing, model):
    coded = pieces.decode(pieces.encode(awkward, model), model)
    assert coded.columns == [*awkward.columns, "pieces", "decoded"]
    rows = coded.collect()
    assert len(rows) == awkward.count()
    for row in rows:
        assert row.decoded == row.text
        assert (row.pieces is None) == (row.text is None)
    digests = pieces.encode_digest(awkward, model).collect()
    assert all(r.round_trip for r in digests) and len(digests) == len(rows)
    assert pieces.encode(nothing, model).collect() == []
    assert pieces.encode_digest(nothing, model).collect() == []


def test_other_models_are_refused(model):
    from sentencepiece import sentencepiece_model_pb2 as proto

    message = proto.ModelProto()
    message.ParseFromString(model)
    message.trainer_spec.model_type = proto.TrainerSpec.WORD
    with pytest.raises(ValueError):
        pieces.PieceTransducer(message.SerializeToString())
