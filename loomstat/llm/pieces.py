"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

The transducer is the composition of three machines: the normaliser (space to
the visible space, optional dummy prefix), the pieces (an arc per piece, from
its characters to its id) and byte fallback (an arc per character without a
piece, to the ids of its bytes). Path weights add up in the tropical semiring:

* unigram models: an arc weighs minus its piece's score;
* merge models: the pieces are composed with an acceptor of neighbours that
  lets piece b follow piece a only if merging the characters of ab by rank
  gives a and b back. Merging never crosses a boundary that is left at its end,
  so it acts inside each pair as it does alone; hence exactly one path of any
  input is accepted, and it is the segmentation that merging gives.

No piece has the visible space after another character, so paths of different
words are independent. Nor does any path join two characters that are neighbours
in no piece; words are cut there too, and each distinct part is composed once per
cache.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomstat.llm.common import col

SPACE = "▁"
# Kinds of pieces and models as the file format numbers them.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
# What an unknown character costs above the dearest piece, as in the library.
UNKNOWN_PENALTY = 10.0
# Words and pairs remembered per worker; a full cache starts afresh.
CACHE = 250_000
# Rows encoded at a time, so that the ids of few texts are in memory.
ROWS = 256


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class PieceTransducer:
    """The compiled machine of one model file."""

    def __init__(self, data: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in fields(data):
            if number == 1:
                part = dict(fields(value))
                score = struct.unpack("<f", part[2])[0] if 2 in part else 0.0
                pieces.append((part[1].decode("utf-8"), score, part.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, MERGES):
            raise ValueError(f"model type {self.kind}: only unigram and merge models have a transducer")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only the identity normaliser with visible spaces before words is compiled")
        self.prefix = bool(normalizer.get(3, 1))
        self.names = [p[0] for p in pieces]
        self.kinds = [p[2] for p in pieces]
        self.unknown = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        self.byte_ids = {int(p[0][3:5], 16): i for i, p in enumerate(pieces) if p[2] == BYTE}
        if self.byte_ids and len(self.byte_ids) < 256:
            raise ValueError("byte fallback needs all 256 byte pieces")
        self.arcs = {p[0]: i for i, p in enumerate(pieces) if p[2] in (NORMAL, USER_DEFINED)}
        if any(SPACE in name.lstrip(SPACE) for name in self.arcs):
            raise ValueError("a piece has a space after another character: words are not independent")
        self.weight = [-p[1] for p in pieces]
        self.longest = max(map(len, self.arcs), default=1)
        least = min((p[1] for p in pieces if p[2] == NORMAL), default=0.0)
        self.unknown_weight = UNKNOWN_PENALTY - least
        # Beginnings of pieces, to stop at the first that no piece has.
        self.beginnings = {name[:n] for name in self.arcs for n in range(1, len(name) + 1)}
        # How far a piece can reach by the three characters it begins with; others have two at most.
        self.reach: dict[str, int] = {}
        for name in self.arcs:
            if len(name) > 2:
                self.reach[name[:3]] = max(len(name), self.reach.get(name[:3], 0))
        # Neighbours in some piece: between any others every path has a boundary.
        self.joints = {name[i : i + 2] for name in self.arcs for i in range(len(name) - 1)}
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.rank = {name: self.weight[i] for name, i in self.arcs.items()}
        self.ends: dict[str, tuple | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        out = []
        for i, (name, _, kind) in enumerate(pieces):
            if kind == BYTE:
                out.append(bytes([int(name[3:5], 16)]))
            elif kind == CONTROL:
                out.append(b"")
            else:
                out.append((" ⁇ " if kind == UNKNOWN else name.replace(SPACE, " ")).encode("utf-8"))
        self.output = out

    def merged(self, text: str) -> list[tuple]:
        """Join neighbours, best rank first and leftmost of equals, until none is a piece: trees (part, rank, left, right)."""
        trees: list[tuple] = [(c, -math.inf, None, None) for c in text]
        while len(trees) > 1:
            best, at = math.inf, -1
            for i in range(len(trees) - 1):
                piece = self.arcs.get(trees[i][0] + trees[i + 1][0])
                if piece is not None and self.weight[piece] < best:
                    best, at = self.weight[piece], i
            if at < 0:
                break
            left, right = trees[at : at + 2]
            trees[at : at + 2] = [(left[0] + right[0], best, left, right)]
        return trees

    def sides(self, part: str) -> tuple | None:
        """What stands at the left and at the right end of a part while it is merged: lists of (symbol, made at rank, gone at rank).

        None if merging does not give the part as a whole. A rank says when a
        symbol is made only if it is later than those of the symbol's own parts;
        where that fails the lists are empty.
        """
        known = self.ends.get(part)
        if known is None and part not in self.ends:
            trees = self.merged(part)
            if len(trees) == 1:
                lists, ordered = [], True
                for side in (2, 3):
                    tree, gone, chain = trees[0], math.inf, []
                    while tree is not None:
                        chain.append((tree[0], tree[1], gone))
                        ordered &= tree[1] < gone
                        gone, tree = tree[1], tree[side]
                    lists.append(chain)
                known = tuple(lists) if ordered else ([], [])
            if len(self.ends) >= CACHE:
                self.ends.clear()
            self.ends[part] = known
        return known

    def follows(self, a: str, b: str) -> bool:
        """The acceptor of neighbours of a merge model, for parts that merging makes whole.

        The boundary of ab is lost if at some time the symbol on its left and the
        symbol on its right are there together and their join comes first: before
        the left one is merged to its own left (which goes first at equal
        ranks) and not after the right one is merged to its own right.
        """
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            ends, begins = self.sides(a)[1], self.sides(b)[0]
            if ends and begins:
                known = not any(
                    self.rank.get(x + y, math.inf) < x_gone and self.rank.get(x + y, math.inf) <= y_gone
                    for x, x_made, x_gone in ends
                    for y, y_made, y_gone in begins
                    if x_made < y_gone and y_made < x_gone and x + y in self.rank
                )
            else:
                known = [t[0] for t in self.merged(a + b)] == [a, b]
            self.pairs[key] = known
        return known

    def arcs_from(self, text: str, start: int) -> Iterator[tuple[int, int | None]]:
        """(end, piece) of the arcs that leave a place; piece None is the fallback for one character."""
        arcs, beginnings = self.arcs, self.beginnings
        if text[start] not in arcs:
            yield start + 1, None
        for end in range(start + 1, min(len(text), start + self.longest) + 1):
            part = text[start:end]
            if part not in beginnings:
                break
            piece = arcs.get(part)
            if piece is not None:
                yield end, piece

    def path(self, text: str) -> list[tuple[int, int, int | None]]:
        """The arcs (start, end, piece) of the shortest path through the composition with ``text``."""
        return self.lightest(text) if self.kind == UNIGRAM else self.accepted(text)

    def lightest(self, text: str) -> list[tuple[int, int, int | None]]:
        """Relax every arc from left to right; ties keep the path found first, that is the longer last piece."""
        n = len(text)
        best: list = [None] * (n + 1)
        best[0] = (0.0, 0, None)
        for start in range(n):
            here = best[start]
            if here is None:
                continue
            for end, piece in self.arcs_from(text, start):
                total = here[0] + (self.unknown_weight if piece is None else self.weight[piece])
                if best[end] is None or total < best[end][0]:
                    best[end] = (total, start, piece)
        arcs, at = [], n
        while at:
            _, start, piece = best[at]
            arcs.append((start, at, piece))
            at = start
        return arcs[::-1]

    def accepted(self, text: str) -> list[tuple[int, int, int | None]]:
        """The one path that the acceptor of neighbours lets through, all of whose weights are zero.

        The composition is expanded depth first, long pieces before short ones,
        and arcs are made only when they are tried; a state (last piece, place)
        that leads nowhere is left once and for all.
        """
        n = len(text)
        arcs, ends, pairs, reach = self.arcs, self.ends, self.pairs, self.reach
        path: list[tuple[int, int, int | None]] = []
        dead: set[tuple[int, int]] = set()
        start, before, end = 0, "", min(n, reach.get(text[:3], 2))
        while start < n:
            while end > start:
                part = text[start:end]
                piece = arcs.get(part)
                if (piece is not None or end == start + 1) and (not dead or (start, end) not in dead) and (ends.get(part) or self.sides(part)):
                    if not before:
                        break
                    fits = pairs.get((before, part))
                    if fits or (fits is None and self.follows(before, part)):
                        break
                end -= 1
            if end > start:
                path.append((start, end, piece))
                start, before = end, part
                end = min(n, start + reach.get(text[start : start + 3], 2))
            else:
                low, high, _ = path.pop()
                dead.add((low, high))
                start, end = low, high - 1
                before = text[path[-1][0] : low] if path else ""
        return path

    def emit(self, text: str) -> list[int]:
        """Piece ids of a normalised text."""
        ids: list[int] = []
        for start, end, piece in self.path(text):
            if piece is not None:
                ids.append(piece)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in text[start:end].encode("utf-8")]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def split(self, text: str) -> list[str]:
        """Normalise, and cut before every run of spaces that follows another character."""
        if not text:
            return []
        words = ((" " if self.prefix else "") + text).replace(SPACE, " ").split(" ")
        out, spaces = [], 0
        if words[0]:
            out.append(words[0])
        for word in words[1:]:
            spaces += 1
            if word:
                out.append(SPACE * spaces + word)
                spaces = 0
        if spaces:
            out.append(SPACE * spaces)
        return out

    def cut(self, word: str) -> list[str]:
        """Cut a word where no piece holds both neighbours; unknown characters in a row share an id, so without byte fallback it stays whole."""
        if not self.byte_ids:
            return [word]
        joints = self.joints
        places = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in joints]
        return [word[low:high] for low, high in zip([0, *places], [*places, len(word)])] if places else [word]

    def encode(self, text: str) -> np.ndarray:
        """Piece ids of a raw text."""
        cache, out = self.words, []
        for word in self.split(text):
            ids = cache.get(word)
            if ids is None:
                parts = self.cut(word)
                for part in parts:
                    ids = cache.get(part)
                    if ids is None:
                        if len(cache) >= CACHE:
                            cache.clear()
                        ids = np.array(self.emit(part), dtype=self.dtype).tobytes()
                        if len(part) <= 64:
                            cache[part] = ids
                    out.append(ids)
            else:
                out.append(ids)
        return np.frombuffer(b"".join(out), dtype=self.dtype)

    def decoded(self, ids: list[int]) -> bytes:
        """The inverted machine: UTF-8 of piece ids, less the dummy prefix."""
        text = b"".join(map(self.output.__getitem__, ids))
        return text[1:] if self.prefix and text[:1] == b" " else text

    def decode(self, ids) -> str:
        """Text of piece ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decoded(list(ids)).decode("utf-8", "replace")


_MACHINES: dict[int, PieceTransducer] = {}


def machine_of(model: bytes) -> PieceTransducer:
    """The machine of a model, compiled once per worker."""
    key = hash(model)
    if key not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[key] = PieceTransducer(model)
    return _MACHINES[key]


def read_model(path: str) -> bytes:
    """A model file of the driver; a vocabulary is bounded (some MB), so its bytes may travel with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def add_column(df: DataFrame, source: str, out: str, kind: T.DataType, make: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """Add a column made from another by Arrow batches of few rows; a column named like ``out`` is replaced."""
    kept = [c for c in df.columns if c != out]
    # Names may repeat up to case or hold dots, so the batches go by position.
    plain = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)], col(source).alias("source"))
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("made", kind)])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], make(part.columns[-1])], schema.names)

    return plain.mapInArrow(made, schema).toDF(*kept, out)


def encode(docs: DataFrame, model: bytes, text: str = "text", out: str = "pieces") -> DataFrame:
    """Add ``out``: array<int> of piece ids. A null text has null pieces, an empty one none.

    Visible spaces in a text are read as spaces, as the format has it. A column
    named like ``out`` is replaced. Rows do not depend on each other, so empty
    tables and repeated rows are no special cases.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def ids(texts: pa.Array) -> pa.Array:
        machine = machine_of(broadcast.value)
        lists = [machine.encode(t or "") for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        values = np.concatenate(lists).astype(np.int32) if lists else np.zeros(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=texts.is_null())

    return add_column(docs, text, out, T.ArrayType(T.IntegerType()), ids)


def decode(docs: DataFrame, model: bytes, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of an array of piece ids; null for null."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def texts(lists: pa.Array) -> pa.Array:
        machine = machine_of(broadcast.value)
        return pa.array([None if ids is None else machine.decode(ids) for ids in lists.to_pylist()], pa.string())

    return add_column(docs, pieces, out, T.StringType(), texts)


def encode_digest(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_pieces, n_bytes (of fallback), ids_sha256 (ids as four bytes each, lowest first), round_trip.

    Encodes and decodes in one pass over Arrow batches, so the ids of long
    texts never travel. round_trip says that decoding gives the text back
    (visible spaces of the text as spaces). Null and empty texts have no
    pieces; equal rows give equal rows, one each; an empty table gives none.
    Ids are read as long; other columns are not looked at.
    """
    from hashlib import sha256

    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(broadcast.value)
        is_byte = np.array([k == BYTE for k in machine.kinds])
        for batch in batches:
            rows = []
            for value in batch.column(1):
                content = value.as_py() or ""
                ids = machine.encode(content)
                same = machine.decoded(ids.tolist()) == content.replace(SPACE, " ").encode("utf-8")
                rows.append((len(ids), int(np.count_nonzero(is_byte[ids])), sha256(ids.astype("<i4").tobytes()).hexdigest(), same))
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", "n_pieces", "n_bytes", "ids_sha256", "round_trip"])

    narrow = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    return narrow.mapInArrow(coded, "doc_id long, n_pieces long, n_bytes long, ids_sha256 string, round_trip boolean")
