"""Embedding near-duplicates by hierarchical navigable small-world graphs per shard.

Vectors that may link (equal labels) are dealt into shards of bounded size. A
task holds the graph of one shard and a bounded chunk of the queries; every
vector of the label queries every shard. A search whose audit against brute
force misses a link gives way to all pairs, cosines are verified in double
precision, and links are reduced to a spanning forest before components are
formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import col, components
from loomstat.llm.simhash import Forest
from loomstat.operators.joins import lookup_join
from loomstat.session import cut_lineage

THRESHOLD = 0.93
# Vectors per graph, and queries per task and graph.
SHARD = 8192
CHUNK = 65_536
# Links per node (twice as many on the ground layer), beam while building and beam while searching.
LINKS = 12
BUILD_BEAM = 48
BEAM = 32
# Queries of a chunk that are audited against brute force: at least so many, and until so many of them had links that a
# beam can hold; queries compared at a time.
AUDITS = 256
AUDIT_LINKED = 4096
BATCH = 256
# Single-precision similarities only propose links.
SLACK = 1e-4


class Graph:
    """A navigable small-world graph over unit vectors; all searches walk many queries at once."""

    def __init__(self, vectors: np.ndarray, draws: np.ndarray):
        """``draws``: a number in [0, 1) per vector that decides its top layer."""
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        tops = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(LINKS)).astype(int), 6)
        self.layers = [np.full((n, LINKS if level else 2 * LINKS), -1, dtype=np.int32) for level in range(int(tops.max(initial=0)) + 1)]
        order = np.argsort(-tops, kind="stable")
        self.entry = int(order[0]) if n else -1
        self.tops = tops
        done = min(n, 1)
        while done < n:
            # The graph at most doubles with a batch, so a batch sees a fair sample of it.
            more = order[done : done + min(max(done, 16), BATCH)]
            self._insert(more, order[:done])
            done += len(more)

    def _insert(self, new: np.ndarray, old: np.ndarray) -> None:
        start = np.full((len(new), 1), self.entry, dtype=np.int32)
        for level in range(len(self.layers) - 1, -1, -1):
            found, sims = self.beam(self.x[new], level, start, BUILD_BEAM if level <= self.tops[new].max() else 4)
            start = found[:, :4]
            here = np.nonzero(self.tops[new] >= level)[0]
            if not len(here):
                continue
            nodes = new[here]
            # Members of the batch are candidates of each other, too.
            mutual = self.x[nodes] @ self.x[nodes].T
            np.fill_diagonal(mutual, -np.inf)
            near = np.argsort(-mutual, axis=1, kind="stable")[:, :BUILD_BEAM]
            candidates = np.concatenate([found[here], nodes[near]], axis=1).astype(np.int32)
            scores = np.concatenate([sims[here], np.take_along_axis(mutual, near, axis=1)], axis=1)
            candidates[~np.isfinite(scores)] = -1
            self._link(level, nodes, candidates, scores)

    def _diverse(self, candidates: np.ndarray, scores: np.ndarray, width: int) -> np.ndarray:
        """Of each row the best candidates, leaving out those closer to a chosen one than to the row's own vector; filled up with the best of these."""
        rows, n = candidates.shape
        order = np.argsort(-np.where(candidates >= 0, scores, -np.inf), axis=1, kind="stable")
        candidates = np.take_along_axis(candidates, order, axis=1)
        scores = np.where(candidates >= 0, np.take_along_axis(scores, order, axis=1), -np.inf)
        vectors = self.x[np.maximum(candidates, 0)]
        between = np.einsum("bid,bjd->bij", vectors, vectors)
        chosen = np.zeros((rows, n), dtype=bool)
        closest = np.full((rows, n), -np.inf, dtype=np.float32)
        count = np.zeros(rows, dtype=int)
        for i in range(n):
            take = np.isfinite(scores[:, i]) & (closest[:, i] < scores[:, i]) & (count < width)
            chosen[:, i] = take
            count += take
            closest = np.where(take[:, None], np.maximum(closest, between[:, i, :]), closest)
        # Chosen first, the rest by closeness.
        rank = np.where(np.isfinite(scores), np.arange(n)[None, :] + np.where(chosen, 0, n), 4 * n)
        pick = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(candidates, pick, axis=1)
        out[np.take_along_axis(rank, pick, axis=1) >= 4 * n] = -1
        return out

    def _link(self, level: int, nodes: np.ndarray, candidates: np.ndarray, scores: np.ndarray) -> None:
        layer = self.layers[level]
        width = layer.shape[1]
        chosen = self._diverse(candidates, scores, width if level else LINKS)
        layer[nodes, : chosen.shape[1]] = chosen
        # Back links: what points at a node joins its neighbours, and the best mix stays.
        source = np.repeat(nodes, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        touched, first, count = np.unique(target, return_index=True, return_counts=True)
        for low in range(0, len(touched), BATCH):
            part = slice(low, low + BATCH)
            most = int(min(count[part].max(), 64))
            place = first[part][:, None] + np.arange(most)[None, :]
            inside = np.arange(most)[None, :] < count[part][:, None]
            incoming = np.where(inside, source[np.minimum(place, len(source) - 1)], -1).astype(np.int32)
            both = np.concatenate([layer[touched[part]], incoming], axis=1)
            both = np.where((both[:, :, None] == both[:, None, :]).argmax(axis=2) == np.arange(both.shape[1]), both, -1)
            sims = np.einsum("bd,bnd->bn", self.x[touched[part]], self.x[np.maximum(both, 0)])
            layer[touched[part]] = self._diverse(both, sims, width)

    def beam(self, queries: np.ndarray, level: int, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of one layer: (nodes, similarities), best first, -1 where fewer are reachable."""
        queries = queries.astype(np.float32)
        layer, n, b = self.layers[level], len(self.x), len(queries)
        rows = np.arange(b)[:, None]
        visited = np.zeros((b, n + 1), dtype=bool)
        nodes = np.full((b, width), -1, dtype=np.int32)
        sims = np.full((b, width), -np.inf, dtype=np.float32)
        open_ = np.zeros((b, width), dtype=bool)
        fresh = start[:, :width]
        live = np.arange(b)
        step = 4
        while True:
            # Mark, drop repeats, score and merge the fresh nodes of all live queries.
            seen = visited[live[:, None], fresh] | (fresh < 0)
            fresh = np.where(seen, -1, fresh)
            ordered = np.sort(fresh, axis=1)
            ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
            fresh = ordered
            visited[live[:, None], np.where(fresh < 0, n, fresh)] = True
            visited[:, n] = False
            score = np.einsum("bd,bnd->bn", queries[live], self.x[np.maximum(fresh, 0)])
            score = np.where(fresh >= 0, score, -np.inf)
            all_nodes = np.concatenate([nodes[live], fresh], axis=1)
            all_sims = np.concatenate([sims[live], score], axis=1)
            all_open = np.concatenate([open_[live], fresh >= 0], axis=1)
            pick = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            nodes[live] = np.take_along_axis(all_nodes, pick, axis=1)
            sims[live] = np.take_along_axis(all_sims, pick, axis=1)
            open_[live] = np.take_along_axis(all_open, pick, axis=1) & (nodes[live] >= 0)
            live = live[open_[live].any(axis=1)]
            if not len(live):
                return nodes, sims
            # Expand the best open nodes of each query.
            choose = np.argsort(~open_[live], axis=1, kind="stable")[:, :step]
            is_open = np.take_along_axis(open_[live], choose, axis=1)
            expand = np.where(is_open, np.take_along_axis(nodes[live], choose, axis=1), -1)
            open_[live[:, None], choose] = False
            fresh = np.where(expand[:, :, None] >= 0, layer[np.maximum(expand, 0)], -1).reshape(len(live), -1)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """From the top layer down, then a beam on the ground."""
        start = np.full((len(queries), 1), self.entry, dtype=np.int32)
        for level in range(len(self.layers) - 1, 0, -1):
            start = self.beam(queries, level, start, 4)[0]
        return self.beam(queries, 0, start, min(width, len(self.x)))


class ShardLinks:
    """Links between the queries of a chunk and the members of a shard.

    Searches propose links, cosines in double precision confirm them, and
    confirmed links make groups. A query whose whole beam lies within the
    threshold may have more links than the beam holds, in or out of its group,
    so it meets every member of the shard in double precision. Every other
    query then meets every member of its group.
    """

    def __init__(self, ids: np.ndarray, copies: np.ndarray, draws: np.ndarray, vectors: np.ndarray, threshold: float):
        self.ids, self.copies, self.draws, self.vectors, self.threshold = ids, copies, draws, vectors, threshold

    @cached_property
    def graph(self) -> Graph:
        return Graph(self.vectors, self.draws)

    def propose(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Confirmed pairs (row, member) of a beam search, and the rows whose beam did not reach past the threshold."""
        rows, members, full = [], [], []
        for low in range(0, len(queries), BATCH):
            batch = queries[low : low + BATCH]
            nodes, sims = self.graph.search(batch, width)
            row, place = np.nonzero(sims >= self.threshold - SLACK)
            node = nodes[row, place]
            sure = np.einsum("nd,nd->n", batch[row], self.vectors[node]) >= self.threshold
            rows.append(row[sure] + low)
            members.append(node[sure])
            full.append(np.nonzero(sims[:, -1] >= self.threshold - SLACK)[0] + low)
        return np.concatenate(rows), np.concatenate(members), np.concatenate(full)

    def join(self, forest: Forest, query_ids: np.ndarray, row: np.ndarray, member: np.ndarray, edges: list) -> int:
        before = len(edges)
        for a, b in zip(query_ids[row].tolist(), self.ids[member].tolist()):
            if a != b and forest.union(a, b):
                edges.append((a, b))
        return len(edges) - before

    def compare(self, forest: Forest, edges: list, query_ids: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Links of the queries at ``rows`` from all members of the shard; each joins the groups of all it links with."""
        n_links = np.zeros(len(rows), dtype=np.int64)
        theirs = None
        for low in range(0, len(rows), BATCH):
            part = rows[low : low + BATCH]
            near = queries[part] @ self.vectors.T >= self.threshold
            near &= query_ids[part][:, None] != self.ids[None, :]
            n_links[low : low + BATCH] = near @ self.copies
            if theirs is None:
                theirs = np.array([forest.root(i) for i in self.ids.tolist()])
            mine = np.array([forest.root(i) for i in query_ids[part].tolist()])
            cross = near & (theirs[None, :] != mine[:, None])
            found = 0
            for k in np.nonzero(cross.any(axis=1))[0]:
                # One member of each other group is enough to join it.
                member = np.nonzero(cross[k])[0]
                member = member[np.unique(theirs[member], return_index=True)[1]]
                found += self.join(forest, query_ids, np.repeat(part[k], len(member)), member, edges)
            if found:
                theirs = None
        return n_links

    def counts(self, forest: Forest, query_ids: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Links of the queries at ``rows``, each itself left out, from all pairs inside each group."""
        n_links = np.zeros(len(rows), dtype=np.int64)
        mine = np.array([forest.root(i) for i in query_ids[rows].tolist()])
        theirs = np.array([forest.root(i) for i in self.ids.tolist()])
        order, member_order = np.argsort(mine, kind="stable"), np.argsort(theirs, kind="stable")
        roots, first = np.unique(mine[order], return_index=True)
        last = np.append(first[1:], len(order))
        low, high = (np.searchsorted(theirs[member_order], roots, side) for side in ("left", "right"))
        for k in np.nonzero(high > low)[0]:
            members = member_order[low[k] : high[k]]
            if last[k] - first[k] == 1 and len(members) == 1 and self.ids[members[0]] == query_ids[rows[order[first[k]]]]:
                continue
            for at in range(first[k], last[k], 1024):
                place = order[at : min(at + 1024, last[k])]
                near = queries[rows[place]] @ self.vectors[members].T >= self.threshold
                near &= query_ids[rows[place]][:, None] != self.ids[members][None, :]
                n_links[place] = near @ self.copies[members]
        return n_links

    def groups(self, query_ids: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, list]:
        """Link counts and a spanning forest with beams of one width."""
        forest, edges = Forest(), []
        row, member, full = self.propose(queries, width)
        self.join(forest, query_ids, row, member, edges)
        rest = np.setdiff1d(np.arange(len(queries)), full)
        n_links = np.zeros(len(queries), dtype=np.int64)
        n_links[full] = self.compare(forest, edges, query_ids, queries, full)
        n_links[rest] = self.counts(forest, query_ids, queries, rest)
        return n_links, edges

    def resolve(self, query_ids: np.ndarray, queries: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, list]:
        """Link counts and a spanning forest, by search if it finds all links of the audited queries, or else from all pairs.

        Audited are the queries at ``order``, one batch after the other, until
        AUDITS have been seen and AUDIT_LINKED of them had links, but fewer than
        the beam holds: queries with more are compared with all members
        anyway. Where such links are rare the audit meets every query and is
        itself the result.
        """
        forest, edges, truth, linked = Forest(), [], np.zeros(0, dtype=np.int64), 0
        while len(truth) < len(order) and (len(truth) < AUDITS or linked < AUDIT_LINKED):
            more = self.compare(forest, edges, query_ids, queries, order[len(truth) : len(truth) + BATCH])
            linked += int(((more > 0) & (more < BEAM)).sum())
            truth = np.concatenate([truth, more])
        if len(truth) == len(queries):
            n_links = np.zeros(len(queries), dtype=np.int64)
            n_links[order] = truth
            return n_links, edges
        n_links, edges = self.groups(query_ids, queries, BEAM)
        if (n_links[order[: len(truth)]] == truth).all():
            return n_links, edges
        edges = []
        return self.compare(Forest(), edges, query_ids, queries, np.arange(len(queries))), edges


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list[np.ndarray]]]:
    """Members and queries of one key after the other, each as its columns joined.

    Rows are (key, query, numbers ..., vector), sorted by key and then by query,
    and the vectors of a key are equally long. Keys without members or without
    queries are passed over.
    """

    def whole(parts: list) -> list[np.ndarray]:
        return [np.concatenate(p) for p in zip(*parts)]

    key, members, queries = None, [], []
    for batch in batches:
        keys = np.array(batch.column(0).to_pylist(), dtype=object)
        is_query = batch.column(1).to_numpy(zero_copy_only=False) == 1
        numbers = [c.to_numpy(zero_copy_only=False) for c in batch.columns[2:-1]]
        cuts = [0, *(np.nonzero(keys[1:] != keys[:-1])[0] + 1).tolist(), len(keys)] if len(keys) else [0]
        for low, high in zip(cuts, cuts[1:]):
            if keys[low] != key:
                if members and queries:
                    yield whole(members), whole(queries)
                key, members, queries = keys[low], [], []
            part = is_query[low:high]
            vectors = batch.columns[-1].slice(low, high - low).flatten().to_numpy(zero_copy_only=False).reshape(high - low, -1)
            for store, rows in ((members, ~part), (queries, part)):
                if rows.any():
                    store.append([*[n[low:high][rows] for n in numbers], vectors[rows]])
    if members and queries:
        yield whole(members), whole(queries)


def shard_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of (key, query, vec_id, copies, draw, audit, vector) to rows (vec_id, n_links, other): links counted per query, and a
    spanning forest of them in ``other``. ``draw`` decides the layer of a member, ``audit`` the order of audits."""
    for (ids, copies, draws, _, known), (query_ids, _, _, audits, vectors) in blocks(batches):
        n_links, edges = ShardLinks(ids, copies, draws, known, THRESHOLD).resolve(query_ids, vectors, np.argsort(audits, kind="stable"))
        pairs = np.array(edges, dtype=np.int64).reshape(-1, 2)
        some = n_links > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([query_ids[some], pairs[:, 0]])),
                pa.array(np.concatenate([n_links[some], np.zeros(len(pairs), dtype=np.int64)])),
                pa.array(np.concatenate([query_ids[some], pairs[:, 1]])),
            ],
            ["vec_id", "n_links", "other"],
        )


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, unit): unit vectors in double precision; null where a vector takes no part."""
    raw = vectors.select(col(vec_id).cast("long").alias("vec_id"), col(label).cast("string").alias("label"), col(embedding).cast("array<double>").alias("v"))
    good = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Scaled by the greatest component first, so that squares neither overflow nor vanish.
    top = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    scaled = raw.withColumn("top", F.when(good, top)).withColumn("v", F.when(F.col("top") > 0, F.transform("v", lambda x: x / F.col("top"))))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return scaled.withColumn("length", length).select("vec_id", "label", F.transform("v", lambda x: x / F.col("length")).alias("unit"))


def group_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of equal labels link when their cosine is at least THRESHOLD.
    Exact copies (equal unit vectors and labels) are one node with a count.
    Vectors that are null, zero, or hold a null or non-finite component, and
    vectors with a null label, link with nothing; vectors of different lengths
    never meet. Rows that repeat a vec_id count as links of each other and
    share the component; a null id takes part under the greatest long value
    and returns as null; an empty table gives none.
    """
    ready = cut_lineage(usable(vectors, vec_id, embedding, label).withColumn("id", F.coalesce("vec_id", F.lit(2**63 - 1))))
    part = ready.where("unit is not null")
    digest = F.md5(F.concat_ws("|", F.col("label"), F.array_join(F.transform("unit", lambda x: x.cast("string")), ",")))
    named = part.withColumn("same", digest)
    # Copies fold before anything is compared; equal digests have equal vectors.
    nodes = cut_lineage(
        named.groupBy("same").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("unit").alias("unit"))
    )
    sizes = nodes.groupBy("label", F.size("unit").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(F.concat_ws("|", "label", "width").alias("part"), F.ceil(F.col("n") / SHARD).cast("int").alias("shards"), F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    dealt = lookup_join(nodes.withColumn("part", F.concat_ws("|", F.col("label"), F.size("unit"))), sizes, "part")
    hashed = F.xxhash64(F.lit("shard"), "node")
    own_shard, own_chunk = F.pmod(hashed, F.col("shards")), F.pmod(F.shiftright(hashed, 20), F.col("chunks"))
    members = dealt.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(F.concat_ws("|", "part", own_shard, "at").alias("key"), F.lit(0).alias("query"), "node", "copies", "unit")
    queries = dealt.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(F.concat_ws("|", "part", "at", own_chunk).alias("key"), F.lit(1).alias("query"), "node", "copies", "unit")
    draw = F.pmod(F.xxhash64(F.lit("draw"), "node"), F.lit(1 << 40)) / float(1 << 40)
    audit = F.xxhash64(F.lit("audit"), "node")
    rows = members.union(queries).select("key", "query", "node", "copies", draw.alias("draw"), audit.alias("audit"), "unit")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartition(parts, "key").sortWithinPartitions("key", "query", "node")
    found = cut_lineage(sorted_rows.mapInArrow(shard_links, "vec_id long, n_links long, other long"))
    linked = found.groupBy(F.col("vec_id").alias("node")).agg(F.sum("n_links").alias("links"))
    roots = components(found.where("vec_id <> other").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    classes = nodes.select("same", "node", "copies").join(linked, "node", "left").join(roots, "node", "left")
    classes = classes.select(F.col("same").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    joined = ready.select("vec_id", "id", F.when(F.col("unit").isNotNull(), digest).alias("same")).join(classes, F.col("same") == F.col("class"), "left")
    component = F.when(F.coalesce("component_id", "id") == 2**63 - 1, F.lit(None)).otherwise(F.coalesce("component_id", "id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
