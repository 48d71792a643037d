"""Language-model scores by a weighted backoff automaton that no machine holds whole.

States are the n-grams seen in training, down to the empty one. A state has an
arc for every token seen after it, weighing the log probability, and a failure
arc to its longest proper suffix, weighing the log of the mass left over by
discounting. A text is scored in one sweep from left to right that carries the
state.

The automaton can be far larger than memory, so every group of documents gets
the part it can reach. Documents are dealt into groups of bounded size; each
group asks for the counts of its distinct n-grams, level by level from the
longest; n-grams meet in buckets of their hash, are summed over all groups, and
the sums go back. One group of those that hold an n-gram owns it and passes it
on to the n-gram's history, so that followers are counted once. A frequent
word costs one entry per group, and a bucket holds a hash range, so no key is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import col
from loomstat.session import work_path

# Tokens of a group of documents; a longer document is a group of its own.
GROUP_TOKENS = 1_000_000
# Wanted tokens per bucket of n-grams.
BUCKET_TOKENS = 2_000_000
# No word holds a line feed, so these are not words.
END, START = b"\n</s>", b"\n<s>"
ROWS = "gid long, level int, bucket int, data binary"
REPLY = ROWS + ", sums array<double>"


def held(doc_id: int | None) -> bool:
    """crc32(doc_id as text) mod 7 is 2; a null id counts as the empty text."""
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def pack(*arrays: np.ndarray) -> bytes:
    """Compressed arrays, byte planes apart so that small numbers shrink well."""
    parts = [np.array([len(arrays)], dtype="<i8").tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(np.array([len(a), a.dtype.itemsize, ord(a.dtype.kind)], dtype="<i8").tobytes())
        parts.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    (n,), at, out = np.frombuffer(raw, "<i8", 1), 8, []
    for _ in range(n):
        length, size, kind = np.frombuffer(raw, "<i8", 3, at).tolist()
        at += 24
        planes = np.frombuffer(raw, np.uint8, length * size, at).reshape(size, length)
        out.append(np.ascontiguousarray(planes.T).view(f"<{chr(kind)}{size}").ravel())
        at += length * size
    return out


def small(a: np.ndarray) -> np.ndarray:
    """Counts as the narrowest unsigned type."""
    return a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def extended(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Key of an n-gram from the keys of its history and its last token (a 64-bit mix)."""
    x = history * np.uint64(0x9E3779B97F4A7C15) + (token ^ np.uint64(0xD1B54A32D192ED03))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def encode_groups(batches: Iterator[pa.RecordBatch], group_tokens: int) -> Iterator[pa.RecordBatch]:
    """Documents to rows of one group each: ids, null flags, lengths, hold-out flags, local token ids, token hashes.

    Texts are read once; later passes see token ids only.
    """
    part, made = TaskContext.get().partitionId() << 24, 0
    ids: list[int | None] = []
    lengths: list[int] = []
    tokens: list[np.ndarray] = []
    words: dict[bytes, int] = {END: 0}
    count = 0

    def row():
        nonlocal made, count
        hashes = np.fromiter(map(hash_of, words), dtype=np.uint64, count=len(words))
        flags = np.array([held(i) for i in ids], dtype=np.uint8)
        null = np.array([i is None for i in ids], dtype=np.uint8)
        data = pack(
            np.array([i or 0 for i in ids], dtype=np.int64), null, np.array(lengths, dtype=np.int32), flags, np.concatenate(tokens).astype(np.int32), hashes
        )
        out = pa.RecordBatch.from_arrays(
            [pa.array([part + made]), pa.array([0], pa.int32()), pa.array([count]), pa.array([data], pa.binary())], ["gid", "level", "tokens", "data"]
        )
        made, count = made + 1, 0
        for kept in (ids, lengths, tokens, words):
            kept.clear()
        words[END] = 0
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
            if count and count + len(found) + 1 > group_tokens:
                yield row()
            local = [words.setdefault(w, len(words)) for w in found]
            local.append(0)
            ids.append(doc)
            lengths.append(len(local))
            tokens.append(np.array(local, dtype=np.int32))
            count += len(local)
    if ids:
        yield row()


class Group:
    """N-grams of one group of documents, by level.

    The sequence of all documents holds a start mark before each. ``keys[k]``
    are the distinct (k + 1)-grams in order, ``at[k]`` the index of the one that
    ends at each place (-1 where the document is too short).
    """

    def __init__(self, data: bytes, order: int):
        self.ids, self.null, self.lengths, self.held, local, hashes = unpack(data)
        n = len(self.lengths)
        places = np.arange(len(local)) + np.repeat(np.arange(n), self.lengths) + 1
        self.size = len(local) + n
        self.real = np.zeros(self.size, dtype=bool)
        self.real[places] = True
        self.trains = np.repeat(self.held == 0, self.lengths + 1)
        now = np.full(self.size, np.uint64(hash_of(START)), dtype=np.uint64)
        now[places] = hashes[local]
        last, valid = now, np.ones(self.size, dtype=bool)
        self.keys, self.at, self.counts = [], [], []
        for level in range(order):
            if level:
                now = np.concatenate([now[:1], extended(now[:-1], last[1:])])
                valid = np.concatenate([[False], valid[:-1]]) & self.real
            keys, inverse = np.unique(now[valid], return_inverse=True)
            at = np.full(self.size, -1, dtype=np.int32)
            at[valid] = inverse
            self.keys.append(keys)
            self.at.append(at)
            self.counts.append(np.bincount(at[valid & self.trains], minlength=len(keys)))

    def previous(self, level: int) -> np.ndarray:
        """Index of the n-gram of a level that ends one place before."""
        return np.concatenate([[-1], self.at[level][:-1]])

    def linked(self, level: int, target: np.ndarray) -> np.ndarray:
        """For each n-gram of a level, what ``target`` has at its places (the same at all of them)."""
        out = np.zeros(len(self.keys[level]), dtype=np.int64)
        here = self.at[level] >= 0
        out[self.at[level][here]] = target[here]
        return out

    def followers(self, level: int, total: np.ndarray, owned: np.ndarray) -> list[np.ndarray]:
        """For each n-gram of a level, how many owned followers were seen once, twice, more often."""
        history = self.linked(level + 1, self.previous(level))
        n = len(self.keys[level])
        classes = np.minimum(total, 3)
        return [np.bincount(history[owned & (classes == c)], minlength=n) for c in (1, 2, 3)]


def requests(group: Group, gid: int, level: int, bits: int, more: list[np.ndarray]) -> list[tuple]:
    """Rows that ask for the counts of a level, one per bucket: key steps, own counts, own followers."""
    keys, out = group.keys[level], []
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    for b in np.unique(bucket).tolist():
        here = slice(cuts[b], cuts[b + 1])
        steps = np.diff(keys[here], prepend=np.uint64(0))
        out.append((gid, level + 1, b, pack(steps, small(group.counts[level][here]), *[small(m[here]) for m in more])))
    return out


def summed(rows: pd.DataFrame) -> pd.DataFrame:
    """Answers of one bucket of one level: sums over all groups in the order asked, and one row of totals (gid -1)."""
    rows = rows.sort_values("gid")
    asked = [unpack(d) for d in rows["data"]]
    keys = np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked])
    counts = np.concatenate([a[1] for a in asked]).astype(np.int64)
    distinct, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
    seen = np.nonzero(counts)[0][::-1]
    owner = np.full(len(distinct), -1, dtype=np.int64)
    owner[inverse[seen]] = seen  # the first of those that train on it, as later writes are of earlier rows
    answers = [total[inverse] * 2 + (owner[inverse] == np.arange(len(keys)))]
    for i in range(2, len(asked[0])):
        answers.append(np.bincount(inverse, weights=np.concatenate([a[i] for a in asked]), minlength=len(distinct)).astype(np.int64)[inverse])
    ends = np.cumsum([len(a[0]) for a in asked])[:-1]
    parts = [np.split(a, ends) for a in answers]
    level, bucket = int(rows["level"].iloc[0]), int(rows["bucket"].iloc[0])
    out = [(gid, level, bucket, pack(*[small(p[i]) for p in parts]), None) for i, gid in enumerate(rows["gid"])]
    token = (distinct != np.uint64(hash_of(START))) & (total > 0)
    sums = [float((total == c).sum()) for c in (1, 2, 3, 4)] + [float(total[token].sum()), float(token.sum())]
    out.append((-1, level, bucket, b"", sums))
    return pd.DataFrame(out, columns=["gid", "level", "bucket", "data", "sums"])


def discounts(sums: list[float]) -> np.ndarray:
    """What to take off counts of 0, 1, 2 and more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = sums[:4]
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d3 = 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2
    return np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, d3]).clip([0, 0.05, 0.05, 0.05], [0, 0.999, 1.95, 2.9])


def answers_of(rows: pd.DataFrame, level: int) -> list[np.ndarray]:
    """The answers of a level in key order: totals, owner flags, and followers if the level was asked for them."""
    mine = rows[rows["level"] == level + 1].sort_values("bucket")
    parts = [unpack(d) for d in mine["data"]]
    joined = [np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(len(parts[0]))]
    return [joined[0] >> 1, (joined[0] & 1).astype(bool), *joined[1:]]


class BackoffAutomaton:
    """The part of the automaton that a group can reach.

    Level k has the states of k-grams. ``arcs[k]`` are log10 probabilities of
    the arcs that spell the (k + 1)-grams of the group, -inf where training has
    none; ``fails[k]`` log10 weights of the failure arcs of k-gram states, 0
    where the k-gram is no state.
    """

    def __init__(self, group: Group, answers: list[list[np.ndarray]], steps: list[np.ndarray], tokens: float, distinct: float):
        first = answers[0][0]
        p = (first + 1.0) / (tokens + distinct + 1.0)
        self.seen = [a[0] > 0 for a in answers]
        self.base = np.log10(p)
        self.arcs, self.fails = [self.base], [np.zeros(0)]
        for level in range(1, len(answers)):
            total, step = answers[level][0], steps[level]
            context = answers[level - 1]
            left = sum(step[c] * f for c, f in zip((1, 2, 3), context[2:]))
            gamma = np.where(context[0] > 0, left / np.maximum(context[0], 1), 1.0)
            gamma = np.where(gamma > 0, gamma, 1.0)
            history = group.linked(level, group.previous(level - 1))
            suffix = group.linked(level, group.at[level - 1])
            own = (total - step[np.minimum(total, 3)]) / np.maximum(context[0][history], 1)
            p = np.where(total > 0, own + gamma[history] * p[suffix], 0.0)
            with np.errstate(divide="ignore"):
                self.arcs.append(np.log10(p))
            # The suffix of an unseen n-gram can be read off lower levels only.
            p = np.where(total > 0, p, 0.0)
            self.fails.append(np.log10(gamma))

    def traverse(self, group: Group) -> np.ndarray:
        """log10 probability of the token at each place.

        The state before a token is the longest n-gram of training that ends
        there. From it failure arcs are followed until a state has an arc for the
        token. Whether an n-gram is in training implies it for its suffixes, so
        all places are walked at once, from the shortest states to the longest.
        """
        out = self.base[group.at[0]]
        for level in range(1, len(self.arcs)):
            at, state = group.at[level], group.previous(level - 1)
            there = at >= 0
            direct = there & np.where(there, self.seen[level][at], False)
            fail = np.where(there, self.fails[level][state], 0.0)
            out = np.where(direct, self.arcs[level][at], out + fail)
        return out


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = 2, group_tokens: int = GROUP_TOKENS, bucket_tokens: int = BUCKET_TOKENS
) -> DataFrame:
    """Score every document by n-grams of the documents that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (both log10 of the whole text, end mark included). Probabilities are
    interpolated with three discounts per level, estimated from all counts of
    counts, down to the add-one unigram of ``base_score``.

    A null or empty text is the end mark alone; ASCII letters are lower-cased;
    repeated rows count as often as they stand; without training documents all
    tokens are unknown; an empty table stays empty.
    """
    spark = docs.sparkSession
    narrow = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    path = work_path(spark, "lm-groups")
    coded = narrow.mapInArrow(lambda batches: encode_groups(batches, group_tokens), "gid long, level int, tokens long, data binary")
    coded.write.option("compression", "none").parquet(path)
    stored = spark.read.schema("gid long, level int, tokens long, data binary").parquet(path)
    total = stored.agg(F.sum("tokens")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(total, 1) / bucket_tokens)))
    groups = stored.select("gid", "level", F.lit(0).alias("bucket"), "data")
    replies: list[DataFrame] = []
    sums: list[list[float]] = []

    def first_requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gid, data in zip(batch.column(0).to_pylist(), batch.column(3)):
                rows = requests(Group(data.as_py(), order), gid, order - 1, bits, [])
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["gid", "level", "bucket", "data"])

    def next_requests(level: int):
        def ask(rows: pd.DataFrame) -> pd.DataFrame:
            group = Group(rows[rows["level"] == 0]["data"].iloc[0], order)
            above = answers_of(rows, level + 1)
            found = requests(group, int(rows["gid"].iloc[0]), level, bits, group.followers(level, above[0], above[1]))
            return pd.DataFrame(found, columns=["gid", "level", "bucket", "data"])

        return ask

    for level in range(order - 1, -1, -1):
        if level == order - 1:
            asked = groups.mapInArrow(first_requests, ROWS)
        else:
            asked = groups.union(replies[0].select("gid", "level", "bucket", "data")).groupBy("gid").applyInPandas(next_requests(level), ROWS)
        path = work_path(spark, f"lm-level-{level}")
        asked.groupBy("bucket").applyInPandas(summed, REPLY).write.option("compression", "none").parquet(path)
        answered = spark.read.schema(REPLY).parquet(path)
        replies.insert(0, answered.where("gid >= 0"))
        parts = answered.where("gid < 0").select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        sums.insert(0, [dict(parts).get(i, 0.0) for i in range(6)])
    steps = [discounts(s) for s in sums]
    tokens, distinct = sums[0][4], sums[0][5]

    def scores(rows: pd.DataFrame) -> pd.DataFrame:
        group = Group(rows[rows["level"] == 0]["data"].iloc[0], order)
        automaton = BackoffAutomaton(group, [answers_of(rows, level) for level in range(order)], steps, tokens, distinct)
        real = group.real
        starts = np.concatenate([[0], np.cumsum(group.lengths)[:-1]])
        first = group.at[0][real]
        per_doc = [np.add.reduceat(v, starts) for v in (automaton.seen[0][first].astype(np.int64), automaton.base[first], automaton.traverse(group)[real])]
        ids = pd.array(group.ids, dtype="Int64")
        ids[group.null == 1] = pd.NA
        return pd.DataFrame(
            {
                "doc_id": ids, "held_out": group.held == 1, "n_tokens": group.lengths.astype(np.int64), "n_known": per_doc[0],
                "train_tokens": np.full(len(ids), int(tokens)), "base_score": per_doc[1], "score": per_doc[2],
            }
        )

    everything = groups
    for reply in replies:
        everything = everything.union(reply.select("gid", "level", "bucket", "data"))
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return everything.groupBy("gid").applyInPandas(scores, result)
