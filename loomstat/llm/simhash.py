"""SimHash near-duplicates: a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import col, components
from loomstat.operators.joins import lookup_join
from loomstat.session import cut_lineage

BITS = 3
SEED = 42
# Two fingerprints within 3 bits share at least 5 of their 8 bytes in place, so at
# least 3 within one half of the positions: one of these 8 triples is shared whole.
LEAST_BYTES = 8 - BITS
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
# Posting lists above this length are dealt in blocks, pair of blocks by pair of blocks.
BLOCK = 2048


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned 64-bit SimHash: majority bits of XXH64 over word shingles, 0 without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    total = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the signed form of the 64-bit fingerprint. ASCII letters are lower-cased."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "fp"])

    return docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text")).mapInArrow(hashed, "doc_id long, fp long")


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the 8 bytes of each xor are zero, that is shared in place."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    differs = (((x & low) + low) | x) & ~low
    return 8 - np.bitwise_count(differs)


def linked_within(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of rows with equal (sorted) keys whose fingerprints are within BITS.

    Compares each row with the one ``d`` places below, for d = 1, 2, ... until no
    run of equal keys is that long.
    """
    left, right = [], []
    rows = np.arange(len(keys))
    d = 1
    while True:
        rows = rows[rows + d < len(keys)]
        rows = rows[keys[rows] == keys[rows + d]]
        if not len(rows):
            break
        x = fps[rows] ^ fps[rows + d]
        near = rows[shared_bytes(x) >= LEAST_BYTES]
        near = near[np.bitwise_count(fps[near] ^ fps[near + d]) <= BITS]
        left.append(near)
        right.append(near + d)
        d += 1
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


class Forest:
    """Union-find over ids met so far; knows which unions were new."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def union(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def posting_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside runs of equal keys of a stream sorted by key, as a spanning forest per batch.

    The last run of a batch waits for the next one, so memory holds a batch and
    one posting block pair.
    """

    def links(keys, fps, nodes):
        i, j = linked_within(keys, fps)
        forest, kept = Forest(), []
        for a, b in zip(nodes[i].tolist(), nodes[j].tolist()):
            if forest.union(a, b):
                kept.append((a, b))
        pairs = np.array(kept, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    rest = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)]
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        now[1] = now[1].view(np.uint64)
        keys, fps, nodes = (np.concatenate(p) for p in zip(rest, now))
        if not len(keys):
            continue
        last = np.searchsorted(keys, keys[-1])
        rest = [keys[last:], fps[last:], nodes[last:]]
        yield links(keys[:last], fps[:last], nodes[:last])
    yield links(*rest)


def candidate_links(nodes: DataFrame) -> DataFrame:
    """Spanning links (a, b) between nodes whose fingerprints differ in at most BITS bits.

    ``nodes`` has one row per distinct fingerprint: fp, node. A posting list is
    all fingerprints with the same three bytes in the same places. A list
    above BLOCK rows is cut into blocks by hash; each pair of blocks is one
    posting of at most two blocks, so no task holds a whole hot list and every
    pair of the list still meets.
    """

    def byte(i: int):
        return F.shiftrightunsigned("fp", 56 - 8 * i).bitwiseAND(F.lit(255))

    def triple(t: int):
        a, b, c = TRIPLES[t]
        return F.lit(t << 24).cast("long") + byte(a) * 65536 + byte(b) * 256 + byte(c)

    posted = nodes.select("fp", "node", F.explode(F.array(*[triple(t) for t in range(len(TRIPLES))])).alias("key"))
    long_lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    long_lists = cut_lineage(long_lists.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    dealt = lookup_join(posted, long_lists, "key")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(own, o) * 32768 + F.greatest(own, o) + 1)
    pair = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(others))
    # The two-block key shares one long: 27 bits of list above 31 of block pair.
    keyed = dealt.withColumn("pair", pair).select((F.col("key") * F.lit(1 << 31) + F.col("pair")).alias("key"), "fp", "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(posting_links, "a long, b long")


def group_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints within 3 bits link their documents; component_id is the
    smallest doc_id reachable. Copies share one node, so they cost one row.
    Null texts count as empty; empty texts have fingerprint 0 and link like any
    other; repeated rows repeat in the result; rows with a null id take the
    component of their fingerprint (null if it has no id); an empty table gives none.
    """
    hashed = cut_lineage(fingerprints(docs, doc_id, text, words))
    nodes = cut_lineage(hashed.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"))
    grouped = components(candidate_links(nodes))
    classes = nodes.join(grouped, "node", "left").select(F.col("fp").alias("class_fp"), F.coalesce("root", "node").alias("component_id"))
    joined = hashed.join(classes, hashed["fp"] == classes["class_fp"], "left")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """The documents less those whose group has a smaller id.

    Rows with a null id stay; rows that repeat an id share its verdict.
    """
    groups = group_near_duplicates(docs, doc_id, text, words).where("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.join(groups, col(doc_id) == F.col("dropped_id"), "left_anti")
