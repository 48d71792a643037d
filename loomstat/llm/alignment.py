"""Alignment of two tokenizers over the same texts.

Texts are deduplicated exactly first: the shuffle is by the full text, and each
distinct text is tokenised and aligned once. What a link of two token ids
counts for is its number of occurrences in all documents, so the counts of a
distinct text weigh as many times as documents hold it. The measures of a text
are then joined to every document that has it.

Both tokenizers cut at a single space between two characters that are not white
space: the byte-level pattern starts a new piece there, and no piece of the
other vocabulary has a space after another character. So the parts between such
spaces are tokenised on their own, once per block of texts, and what a text holds
is put together from its parts.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from loomstat.llm.common import attach_by_key
from loomstat.operators.joins import lookup_join
from loomstat.session import cut_lineage, work_path

SPACE = "▁"
# Fixed value: how byte-level vocabularies of this kind cut texts before merging.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space that both tokenizers cut at. Python takes more characters for white space than they do, which only cuts less.
CUT = re.compile(r"(?<=\S) (?=\S)")
# Below this character the letter and digit classes of all Unicode versions agree, so the faster library serves.
SETTLED = "ɐ"
# White space other than spaces and line ends.
RARE = re.compile(r"[^\S \n]")
# Parts tokenised at a time.
BUNDLE = 256
# After an id in the digest text: inside a side, after A's side, after a group, after the last group of a part.
SIGNS = (b",", b"|", b";", b"\n")
# Texts are put together to blocks of about this many characters.
BLOCK_CHARS = 8_000_000

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers and the alignment of single parts of texts."""

    def __init__(self, byte_json: bytes, piece_model: bytes):
        spec = json.loads(byte_json)
        cutter = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            raise ValueError("the first tokenizer must be a byte-level merge model without a normaliser")
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        self.a_bytes = [b""] * size
        for token in spec["added_tokens"]:
            self.a_bytes[token["id"]] = token["content"].encode()
        ranks = {}
        special = {t["content"] for t in spec["added_tokens"]}
        for token, i in vocabulary.items():
            if token not in special and all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
                ranks[self.a_bytes[i]] = i
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        by_rank = [vocabulary[m] for m in merged]
        self.slow = Tokenizer.from_str(byte_json.decode())
        self.slow.encode_special_tokens = True
        # The faster library merges by id, which is the same where ids follow the merges' order and every byte has one.
        ordered = by_rank == sorted(by_rank) and all(bytes([b]) in ranks for b in range(256)) and len(ranks) == 256 + len(set(merged))
        self.fast = tiktoken.Encoding("first", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}) if ordered else None
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", n) else n.replace(SPACE, " ").encode() for n in names]
        if not all(self.b_bytes) or "" in vocabulary:
            raise ValueError("a token without bytes has no place in a text")
        if any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError("a piece has a space after another character: parts of a text are not independent")
        self.a_sizes, self.b_sizes = (np.array([len(b) for b in table], dtype=np.int64) for table in (self.a_bytes, self.b_bytes))
        # An id as it stands in the digest text, before each of the four signs that can follow it.
        self.ids = max(size, len(names))
        self.written = [b"%d%s" % (i, sign) for sign in SIGNS for i in range(self.ids)]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that have their space already."""
        out: list = [None] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if self.fast is not None and max(text) < SETTLED:
                out[i] = self.fast.encode_ordinary(text)
            else:
                rest.append(i)
        for i, coded in zip(rest, self.slow.encode_batch([texts[i] for i in rest], add_special_tokens=False) if rest else []):
            out[i] = coded.ids
        return out

    def align(self, parts: list[str]) -> Parts:
        """The alignment of each part as it is with a space before it.

        Parts that begin and end in characters are tokenised some hundreds at a time,
        with spaces between them; parts with white space at an end, and those of a
        bundle whose tokens do not give its bytes back, one by one.
        """
        whole = [i for i, p in enumerate(parts) if not (p[0].isspace() or p[-1].isspace())]
        # The few parts with unsettled characters stand together, so that other bundles take the faster way.
        whole.sort(key=lambda i: max(parts[i]) >= SETTLED)
        single = sorted(set(range(len(parts))) - set(whole))
        bundles = [whole[i : i + BUNDLE] for i in range(0, len(whole), BUNDLE)]
        good, a, b = [], [], []

        def encode(groups: list[list[int]]) -> list[int]:
            bad = []
            texts = [" ".join([parts[i] for i in group]) for group in groups]
            for group, text, ids, pieces in zip(groups, texts, self.encode_a([" " + t for t in texts]), self.pieces.encode(texts, num_threads=1)):
                raw = (" " + text).encode()
                if b"".join([self.a_bytes[i] for i in ids]) == raw == b"".join([self.b_bytes[i] for i in pieces]):
                    good.extend(group)
                    a.extend(ids)
                    b.extend(pieces)
                else:
                    bad += group
            return bad

        rest = sorted(single + encode(bundles))
        encode([[i] for i in rest])
        return self.linked(parts, np.array(good, dtype=np.int64), np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))

    def linked(self, parts: list[str], good: np.ndarray, a: np.ndarray, b: np.ndarray) -> Parts:
        """Links and digest texts, given the tokens of the parts in the order of ``good``."""
        n = len(parts)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        part_ends = np.cumsum(np.array([1 + len(parts[i].encode()) for i in good.tolist()], dtype=np.int64))
        total = int(part_ends[-1]) if len(good) else 0

        def marked(places: np.ndarray) -> np.ndarray:
            out = np.zeros(total + 1, dtype=bool)
            out[places] = True
            return out

        # The last tokens of each group: those that end where one of the other side does.
        a_last, b_last = np.flatnonzero(marked(b_ends)[a_ends]), np.flatnonzero(marked(a_ends)[b_ends])
        common = a_ends[a_last]

        def per_part(ends: np.ndarray) -> np.ndarray:
            out = np.zeros(n, dtype=np.int64)
            out[good] = np.bincount(np.searchsorted(part_ends, ends), minlength=len(good))
            return out

        # A's tokens of a group come before B's: each token moves up by the tokens of the other side that precede it.
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        order = np.zeros(len(a) + len(b), dtype=np.int64)
        a_signs = np.zeros(len(a), dtype=np.int64)
        a_signs[a_last] = 1
        b_signs = np.zeros(len(b), dtype=np.int64)
        b_signs[b_last] = np.where(marked(part_ends)[common], 3, 2)
        order[np.arange(len(a)) + np.concatenate([[0], b_last + 1])[a_group]] = a_signs * self.ids + a
        order[np.arange(len(b)) + (a_last + 1)[b_group]] = b_signs * self.ids + b
        written = self.written
        texts = b"".join([written[i] for i in order.tolist()]).split(b"\n")[:-1]
        digests: list[bytes | None] = [None] * n
        for i, text in zip(good.tolist(), texts):
            digests[i] = text
        links = per_part(common)
        # Codes by part number.
        codes = b[b_last] << 32 | a[a_last]
        of = good[np.searchsorted(part_ends, common)]
        return Parts(per_part(a_ends), per_part(b_ends), links, codes[np.argsort(of, kind="stable")], digests)


@dataclass(frozen=True)
class Parts:
    """Per part: tokens of A and of B, links, and the digest text (None where it has no tokens); the codes of all links, part by part."""

    n_a: np.ndarray
    n_b: np.ndarray
    links: np.ndarray
    codes: np.ndarray
    digests: list[bytes | None]


def parts_of(text: str) -> list[str]:
    """The text cut at single spaces between characters that are not white space."""
    if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or RARE.search(text):
        return CUT.split(text)
    return text.split(" ")


class Block:
    """Distinct texts put together; each distinct part of them is tokenised once."""

    def __init__(self):
        self.index: dict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.keys: list[bytes] = []
        self.times: list[int] = []
        self.places: list[np.ndarray] = []
        self.chars = 0

    def add(self, key: bytes, text: str, n: int) -> None:
        index = self.index
        self.keys.append(key)
        self.times.append(n)
        self.places.append(np.array([index[p] for p in parts_of(text)], dtype="<u4"))
        self.chars += len(text)

    def batch(self, number: int, aligner: Aligner) -> pa.RecordBatch:
        """One row: the block's texts, its parts, and its distinct links with their occurrences in all documents."""
        found = aligner.align(list(self.index))
        bad = np.array([d is None for d in found.digests], dtype=bool)
        times = np.zeros(len(bad), dtype=np.int64)
        n_a, n_b, n_groups, digests, parts = [], [], [], [], []
        for places, n in zip(self.places, self.times):
            if bad[places].any():
                places = places[:0]
            np.add.at(times, places, n)
            n_a.append(int(found.n_a[places].sum()))
            n_b.append(int(found.n_b[places].sum()))
            n_groups.append(int(found.links[places].sum()))
            digests.append(hashlib.sha256(b";".join([found.digests[i] for i in places.tolist()])).hexdigest() if len(places) else "")
            parts.append(places.tobytes())
        pairs, which = np.unique(found.codes, return_inverse=True)
        counts = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(counts, which, np.repeat(times, found.links))
        columns = [
            pa.array([number], pa.int64()),
            pa.array([self.keys], pa.list_(pa.binary())),
            *[pa.array([v], pa.list_(pa.int64())) for v in (n_a, n_b, n_groups)],
            pa.array([digests], pa.list_(pa.string())),
            pa.array([parts], pa.list_(pa.binary())),
            pa.array([found.links.astype("<u4").tobytes()], pa.binary()),
            pa.array([which.astype("<u4").tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs)),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(counts)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in BLOCK_SCHEMA.fields])


BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("keys", T.ArrayType(T.BinaryType())),
        *[T.StructField(name, T.ArrayType(T.LongType())) for name in ("n_a", "n_b", "n_groups")],
        T.StructField("digests", T.ArrayType(T.StringType())),
        T.StructField("parts", T.ArrayType(T.BinaryType())),
        T.StructField("lengths", T.BinaryType()),
        T.StructField("links", T.BinaryType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ]
)
TEXT_SCHEMA = T.StructType(
    [T.StructField("key", T.BinaryType()), *[T.StructField(m, T.LongType()) for m in MEASURES], T.StructField("groups_sha256", T.StringType())]
)


def align_blocks(byte_json: bytes, piece_model: bytes):
    """Arrow batches of (key, text, n) to one row for each block of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_json, piece_model)
        block, number = Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for key, text, n in zip(*(batch.column(i) for i in range(3))):
                block.add(key.as_py(), text.as_py(), n.as_py())
                if block.chars >= BLOCK_CHARS:
                    yield block.batch(number, aligner)
                    block, number = Block(), number + 1
        if block.keys:
            yield block.batch(number, aligner)

    return run


def text_measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the corpus-wide figures of their links to the measures of each of their texts."""
    for batch in batches:
        for row in range(batch.num_rows):
            cell = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
            n_pairs = len(cell["pairs"])
            total, best = np.zeros(n_pairs, dtype=np.int64), np.zeros(n_pairs, dtype=np.int64)
            found = cell["found"].values
            if found is not None and len(found):
                at = found.field("at").to_numpy()
                total[at] = found.field("total").to_numpy()
                best[at] = found.field("best").to_numpy()
            lengths = np.frombuffer(cell["lengths"].as_py(), dtype="<u4").astype(np.int64)
            links = np.frombuffer(cell["links"].as_py(), dtype="<u4")
            ends = np.cumsum(lengths)

            def by_part(values: np.ndarray) -> np.ndarray:
                running = np.concatenate([[0], np.cumsum(values[links])])
                return running[ends] - running[ends - lengths]

            total, best = by_part(total), by_part(best)
            places = [np.frombuffer(p, dtype="<u4") for p in cell["parts"].as_py()]
            n_groups = cell["n_groups"].values
            columns = [
                cell["keys"].values, cell["n_a"].values, cell["n_b"].values, n_groups, n_groups,
                pa.array([int(best[p].sum()) for p in places], pa.int64()),
                pa.array([int(total[p].sum()) for p in places], pa.int64()),
                cell["digests"].values,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in TEXT_SCHEMA.fields])


def align_tokenizers(docs: DataFrame, byte_json: bytes, piece_model: bytes) -> DataFrame:
    """Alignment measures of every document.

    ``docs`` needs ``doc_id`` and ``text``; other columns, whatever their names,
    are not read. The two models are given as the contents of their files. One
    row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum (long), groups_sha256. Null and empty texts, and texts whose
    tokens do not give their bytes back (a visible-space character, say), have
    no tokens: zeros and the empty digest text. Repeated rows each get a row and
    each weigh in the counts; a null doc_id stays null. Ties of counts are all
    best. An empty table gives no rows. Texts of any length are read whole; a
    block holds at least one. Ids are cast to long, so text ids fail.
    """
    spark = docs.sparkSession
    key = F.unhex(F.sha2("text", 256))
    keyed = cut_lineage(docs.select("doc_id", F.when(F.col("text") != "", key).alias("key"), F.char_length("text").alias("size")))
    # Every block repeats the common links, so there are no more blocks than their size or the cores ask for.
    chars = keyed.where("key is not null").groupBy("key").agg(F.max("size").alias("size")).agg(F.sum("size")).first()[0] or 0
    n_blocks = max(spark.sparkContext.defaultParallelism, math.ceil(chars / BLOCK_CHARS))
    texts = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n")).select(key.alias("key"), "text", "n").coalesce(n_blocks)
    path = work_path(spark, "alignment")
    texts.mapInArrow(align_blocks(byte_json, piece_model), BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)

    counted = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("total"))
    pairs = cut_lineage(counted.where("total > 0").withColumn("b", F.shiftright("pair", 32)))
    highest = pairs.groupBy("b").agg(F.max("total").alias("highest"))
    figures = lookup_join(pairs, highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))

    wanted = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    found = lookup_join(wanted, figures, "pair", how="inner").groupBy("block").agg(F.collect_list(F.struct("at", "total", "best")).alias("found"))
    measures = cut_lineage(blocks.drop("counts").join(found, "block", "left").mapInArrow(text_measures, TEXT_SCHEMA))

    joined = attach_by_key(keyed.select("doc_id", "key"), measures, "key")
    zero = [F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in MEASURES]
    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
