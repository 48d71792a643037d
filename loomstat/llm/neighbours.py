"""Nearest neighbours by collision-counting hashing.

Every hash function is one random projection, kept as a sorted array. A query
opens a window around its own projection in every array and counts in how many
windows a vector lies; as a window is a range of places in its array, the count
compares each vector's places with the windows' ends. Virtual rehashing widens
the windows with the search radius; vectors whose count exceeds the threshold
are verified by their exact inner product, until the k-th best lies inside the
radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.llm.common import col
from loomstat.llm.vector_groups import blocks
from loomstat.operators.joins import lookup_join
from loomstat.session import cut_lineage

K = 20
# Hash functions, and the share of windows a vector must lie in to be verified.
PROJECTIONS = 96
COLLISIONS = 0.66
# Half a window in units of the radius: a vector at the radius falls inside with probability 0.74.
HALF_WINDOW = 1.133
# Radii in units of the greatest norm; at 2 everything is inside.
RADII = (0.5, 0.9, 1.05, 1.12, 1.19, 1.26, 1.34, 1.45, 1.7, 2.0)
# Vectors per shard (their places fit 16 bits), and queries per task and shard.
SHARD = 65_536
CHUNK = 256
SEED = 20


class CollisionIndex:
    """Sorted projections of one shard.

    Inner products become distances on a sphere: a vector gets one more
    component that lifts its norm to the greatest of the table, a query is
    scaled to that norm, and then the nearest on the sphere has the greatest
    inner product.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float):
        self.ids, self.vectors, self.norm = ids, vectors, norm
        self.axes = np.random.default_rng(SEED).normal(size=(vectors.shape[1] + 1, PROJECTIONS))
        unit = vectors / norm
        lift = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("nd,nd->n", unit, unit)))
        projected = (np.column_stack([unit, lift]) @ self.axes).T.astype(np.float32)
        order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=1)
        # Place of every vector in every sorted array.
        self.places = np.empty(order.shape, dtype=np.uint16 if len(ids) <= 1 << 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=self.places.dtype)[None, :], axis=1)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, rows, inner products) of the k best found of each query."""
        scaled = queries / np.linalg.norm(queries, axis=1)[:, None]
        centre = (scaled @ self.axes[:-1]).astype(np.float32)
        reach = np.array(RADII, dtype=np.float32) * np.float32(HALF_WINDOW)
        # Window ends of all queries, functions and radii.
        low = np.empty((len(queries), PROJECTIONS, len(RADII)), dtype=np.int32)
        high = np.empty_like(low)
        for j in range(PROJECTIONS):
            low[:, j] = np.searchsorted(self.sorted[j], centre[:, j, None] - reach, "left")
            high[:, j] = np.searchsorted(self.sorted[j], centre[:, j, None] + reach, "right")
        for q in range(len(queries)):
            yield q, *self._one(query_ids[q], queries[q], low[q].T, high[q].T, k)

    def collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many of the windows every vector lies."""
        counts = np.zeros(len(self.ids), dtype=np.uint8)
        kind = self.places.dtype
        for places, start, size in zip(self.places, low.astype(kind), (high - low).tolist()):
            if size == len(self.ids):
                counts += 1
            elif size:
                # Places below the start wrap around to large numbers.
                counts += (places - start < kind.type(size)).view(np.uint8)
        return counts

    def _one(self, own: int, query: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        waiting = self.ids != own
        rows, products = np.zeros(0, dtype=np.int64), np.zeros(0)
        length = float(np.linalg.norm(query))
        for level, radius in enumerate(RADII):
            if level == len(RADII) - 1:
                found = np.nonzero(waiting)[0]
            else:
                found = np.nonzero(waiting & (self.collisions(low[level], high[level]) >= COLLISIONS * PROJECTIONS))[0]
            if len(found):
                waiting[found] = False
                rows = np.concatenate([rows, found])
                products = np.concatenate([products, self.vectors[found] @ query])
                best = np.lexsort((self.ids[rows], -products))[:k]
                rows, products = rows[best], products[best]
            # Squared distance on the sphere, in units of the norm: 2 - 2 cos.
            if len(rows) >= k and 2 - 2 * products[k - 1] / (length * self.norm) <= radius * radius:
                break
        return rows, products


def shard_search(batches: Iterator[pa.RecordBatch], k: int, norm: float) -> Iterator[pa.RecordBatch]:
    """Blocks of (key, query, id, vector) to rows (query_id, vec_id, score)."""
    for members, (query_ids, queries) in blocks(batches):
        index = CollisionIndex(*members, norm)
        asked, found, scores = [], [], []
        for q, rows, products in index.search(query_ids, queries, k):
            asked.append(np.full(len(rows), query_ids[q]))
            found.append(index.ids[rows])
            scores.append(products)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in (asked, found, scores)], ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K) -> DataFrame:
    """The k vectors of greatest inner product for each query: query_id, rank, vec_id, score.

    Every vector is a candidate of every query but of its own id; ties go to
    the smaller id. Every shard indexes its vectors and answers chunks of
    queries; the best of all shards are ranked per query.

    Vectors that are null, zero, or hold a null or non-finite component, and
    rows with a null id, take no part; vectors of another length never meet a
    query; of query rows that repeat an id the least vector asks, candidate
    rows that repeat an id all stand in the result; with fewer than k candidates
    all are returned; an empty table gives none.
    """
    rows = vectors.select(col(vec_id).cast("long").alias("id"), col(embedding).cast("array<double>").alias("v"), is_query.alias("asks"))
    good = F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    ready = cut_lineage(rows.where(good).withColumn("width", F.size("v").cast("string")))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    norm = float(ready.agg(F.max(F.sqrt(square))).first()[0] or 1.0)
    queries = ready.where("asks").groupBy("id", "width").agg(F.min("v").alias("v"))
    sizes = ready.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("asked"))
    sizes = sizes.select("width", F.ceil(F.col("n") / SHARD).cast("int").alias("shards"), F.greatest(F.ceil(F.col("asked") / CHUNK), F.lit(1)).cast("int").alias("chunks"))
    hashed = F.xxhash64(F.lit("nearest"), "id")

    def dealt(df: DataFrame, own: Column, own_count: str, spread: str, query: int) -> DataFrame:
        """Rows of a hash part each, repeated for every part of the other side."""
        placed = lookup_join(df, sizes, "width").withColumn("at", F.explode(F.sequence(F.lit(0), F.col(spread) - 1)))
        parts = [F.pmod(own, F.col(own_count)), F.col("at")]
        return placed.select(F.concat_ws("|", "width", *(parts[::-1] if query else parts)).alias("key"), F.lit(query).alias("query"), "id", "v")

    both = dealt(ready, hashed, "shards", "chunks", 0).union(dealt(queries, F.shiftright(hashed, 20), "chunks", "shards", 1))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = both.repartition(parts, "key").sortWithinPartitions("key", "query", "id")
    found = placed.mapInArrow(lambda batches: shard_search(batches, k, norm), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
