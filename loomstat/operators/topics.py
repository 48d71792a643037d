"""Topics and text clusters: LDA, SVD, two NMF losses, EM clusters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.operators.bundles import ADDS, BLOCKS, SLICE, TOTALS, Bundle, Bundles, Strip, binary, block_row, floats, own_sum
from loomstat.operators.factors import factorise
from loomstat.operators.reshape import mean_and_count
from loomstat.operators.strips import list_rows, sum_by
from loomstat.operators.terms import doc_term, limit_terms, tfidf, tokenize
from loomstat.session import cut_lineage, release, sweep

def doc_weights(
    docs: DataFrame, key: str, text: str = "text", min_df: float | int = 1, max_df: float | int = 1.0, weighted: bool = True, **analysis
) -> DataFrame:
    """Long document vectors (key, term, value), weighted tf * (ln((1+n)/(1+df)) + 1) or plain counts.

    The vocabulary is a column, not a list of the driver, so it may be as large as the corpus makes it.
    """
    counts = doc_term(tokenize(docs, key, text, together=True, **analysis), key)
    if not weighted and min_df == 1 and max_df == 1.0:
        return counts.select(key, "term", F.col("tf").cast("double").alias("value"))
    n_docs = docs.count()
    kept = tfidf(limit_terms(counts, key, n_docs, min_df=min_df, max_df=max_df), key, n_docs)
    return kept.select(key, "term", (F.col("tfidf") if weighted else F.col("tf").cast("double")).alias("value"))


TINY = 1e-12


@dataclass
class Topics:
    """(key, weights array) per document and (topic, term, weight) rows."""

    docs: DataFrame
    terms: DataFrame
    k: int
    info: dict = field(default_factory=dict)


def _start(key: str, prefix: str, k: int, seed: int, level: float) -> list[Column]:
    """Positive starting values that depend only on the key, so a lost task
    recomputes the same ones."""
    out = []
    for j in range(k):
        unit = F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(j)), F.lit(1_000_003)) / F.lit(1_000_003.0)
        out.append(((unit + 0.05) * level).alias(f"{prefix}{j}"))
    return out



def _digamma(x: np.ndarray) -> np.ndarray:
    """Recurrence up to 6, then the asymptotic series."""
    x = np.array(x, dtype=float)
    out = np.zeros_like(x)
    while (x < 6).any():
        low = x < 6
        out[low] -= 1 / x[low]
        x[low] += 1
    f = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def topics_lda(
    weights: DataFrame, key: str, k: int, max_iter: int = 10, seed: int = 12345, value: str = "value", prior: float | None = None,
    batches: int | None = None, offset: float = 10.0, decay: float = 0.7,
) -> Topics:
    """Latent Dirichlet allocation by variational Bayes on the long (key, term, value) table.

    Takes TF-IDF weights like counts. The topic-term table has a row per term
    and never leaves Spark; k sums of it reach the driver. The cells are packed once
    into strips of whole documents; in a round each strip meets the rows of its terms,
    fits its documents and sends back what they add to those terms. Priors default to 1 / k.

    With ``batches`` the updates are stochastic: the documents are dealt by
    their key over so many mini-batches, packed into strips of their own, and a round reads each of
    them once. After the n-th of all updates the term table moves by the rate
    (offset + n) ** -decay towards what the mini-batch alone, scaled up to all
    documents, would give.
    """
    alpha = eta = prior if prior is not None else 1.0 / k
    spark = weights.sparkSession
    cells = weights.select(F.col(key).alias("doc"), "term", F.col(value).cast("double").alias("v")).filter("v > 0")
    packed = Bundles(cells, k, batch=None if batches is None else F.pmod(F.xxhash64("doc", F.lit(seed)), F.lit(batches)).cast("int"))
    doc_type = weights.schema[key].dataType

    def sums_of(table: np.ndarray) -> np.ndarray:
        return table.sum(axis=0)

    table = packed.factor(_start("term", "h", k, seed, 1.0), sums_of)

    def fitted(strip: Strip, base: np.ndarray):
        """By ranges of documents: the cells, their terms' rates and, when all are fitted, the documents' weights."""
        beta = np.exp(_digamma(strip.table) - base)
        for low, high in strip.blocks():
            part = slice(strip.first[low], strip.first[high])
            d, rates, v = strip.d[part] - low, beta[strip.t[part]], strip.v[part]
            out = alpha + np.repeat(np.add.reduceat(v, strip.first[low:high] - strip.first[low])[:, None] / k, k, axis=1)
            # A document's weights stand as soon as they settle; its cells leave with those of a fifth of the others. A topic is a row here.
            at, gamma, left_rates, left_v = np.arange(high - low), out.T.copy(), np.ascontiguousarray(rates.T), v
            counts, going = np.diff(strip.first[low : high + 1]), np.ones(high - low, dtype=bool)
            for _ in range(100):
                theta = np.exp(_digamma(gamma) - _digamma(gamma.sum(axis=0)))
                guess = np.repeat(theta[0], counts) * left_rates[0]
                for j in range(1, k):
                    guess += np.repeat(theta[j], counts) * left_rates[j]
                share = left_v / (guess + TINY)
                first = np.cumsum(counts) - counts
                sent = np.stack([np.add.reduceat(row * share, first) for row in left_rates])
                before, gamma = gamma, alpha + theta * sent
                out[at[going]] = gamma.T[going]
                going &= np.abs(gamma - before).mean(axis=0) >= 1e-3
                if not going.any():
                    break
                if going.mean() <= 0.8:
                    kept = np.repeat(going, counts)
                    left_rates, left_v = np.ascontiguousarray(left_rates[:, kept]), left_v[kept]
                    at, gamma, counts = at[going], np.ascontiguousarray(gamma[:, going]), counts[going]
                    going = np.ones(len(at), dtype=bool)
            yield part, d, rates, v, out

    def adds_of(sums: np.ndarray, batch: int | None = None) -> DataFrame:
        """What documents add to each term."""
        base = _digamma(sums)

        def work(bundle: Bundle) -> pa.Table:
            adds = np.zeros_like(bundle.table)
            for *_, strip in bundle.strips():
                own = np.zeros_like(strip.table)
                for part, d, rates, v, gamma in fitted(strip, base):
                    theta = np.exp(_digamma(gamma) - _digamma(gamma.sum(axis=1))[:, None])
                    found = theta[d] * rates
                    found *= (v / (found.sum(axis=1) + TINY))[:, None]
                    own += sum_by(strip.t[part], found, len(own))
                adds[strip.at] += own
            return bundle.sent(adds)

        return packed.passed(table, k, work, ADDS, batch=batch)

    def documents(sums: np.ndarray) -> DataFrame:
        base = _digamma(sums)

        def work(bundle: Bundle) -> pa.Table:
            docs, shares = [], []
            for _, own, strip in bundle.strips():
                gamma = np.concatenate([g for *_, g in fitted(strip, base)])
                docs.append(own.values)
                shares.append(gamma / gamma.sum(axis=1, keepdims=True))
            return document_rows(key, docs, shares)

        schema = T.StructType([T.StructField(key, doc_type), T.StructField("weights", T.ArrayType(T.DoubleType()))])
        return packed.passed(table, k, work, schema).filter(F.col(key).isNotNull())

    def next_table(found: DataFrame, update) -> DataFrame:
        new = cut_lineage(packed.updated(found, table, k, update, sums_of), sized=False)
        release(table)
        sweep(spark)
        return new

    if batches is None:
        for _ in range(max_iter):
            table = next_table(adds_of(own_sum(table)), lambda adds, _: adds + eta)
    else:
        held = {r["batch"]: r["n"] for r in packed.rows.groupBy("batch").agg(F.sum(F.size("docs")).alias("n")).collect()}
        order = [b for _ in range(max_iter) for b in sorted(held)]
        for step, b in enumerate(order, start=1):
            rate, scale = (offset + step) ** -decay, sum(held.values()) / held[b]
            table = next_table(adds_of(own_sum(table), b), lambda adds, old, rate=rate, scale=scale: (1.0 - rate) * old + rate * (eta + scale * adds))
    total = own_sum(table)
    docs = cut_lineage(documents(total))
    terms = cut_lineage(packed.term_rows(table, k, lambda rows: rows / total))
    release(table)
    packed.release()
    sweep(spark)
    return Topics(docs, terms, k)


def document_rows(key: str, docs: Sequence[pa.Array], weights: Sequence[np.ndarray]) -> pa.Table:
    """(key, weights) rows of the documents of several strips."""
    return pa.table([pa.concat_arrays(docs), list_rows(np.concatenate(weights))], names=[key, "weights"])


def topics_svd(
    weights: DataFrame, key: str, k: int, value: str = "value", rounds: int = 200, extra: int | None = None, tol: float = 1e-6, seed: int = 12345,
    start: Column | None = None,
) -> Topics:
    """Truncated SVD: document scores (left vectors times singular values) and
    term loadings (right vectors).

    Subspace iteration on the long (key, term, value) table with ``extra``
    spare directions (``k``, at least 8). The table is packed once into strips of whole
    documents, so a round is one pass: a strip meets the factor's rows of its terms and sends back
    what its documents add to them. Only small square matrices reach the driver. It ends when the residual
    |A v - s u| of every wanted direction is at most ``tol`` of the greatest singular value; it is an
    error if ``rounds`` do not suffice for that. With ``tol`` 0 exactly ``rounds`` are taken.
    ``start`` gives every term the same kind of starting value in place of the seeded ones
    (then without spares). Signs are such that the loadings of every direction add up to at least 0.
    ``info`` has the singular values and, but with ``tol`` 0, the residuals.
    """
    spark = weights.sparkSession
    spare = 0 if start is not None else max(8, k) if extra is None else extra
    packed = Bundles(weights.select(F.col(key).alias("doc"), "term", F.col(value).cast("double").alias("v")), k + spare)
    doc_type = weights.schema[key].dataType
    size = packed.n_docs, packed.n_terms
    width = max(min(k + spare, size[0], size[1]), 1)
    k = min(k, width)
    # A wide factor is taken a few columns at a time.
    n_slices = -(-width // SLICE)
    slices = [slice(*(i * width // n_slices for i in (j, j + 1))) for j in range(n_slices)]

    def own_of(table: np.ndarray) -> np.ndarray:
        """The products of a block's columns, and their sums."""
        return np.concatenate([(table.T @ table).ravel(), table.sum(axis=0)])

    def squares(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = own_sum(table) if size[1] else np.zeros(width * (width + 1))
        return found[: width * width].reshape(width, width), found[width * width :]

    first = [F.lit(1.0) * start] * width if start is not None else [c - 0.5 for c in _start("term", "c", width, seed, 1.0)]
    right = packed.factor(first, own_of)

    def scores(strip: Strip, low: int, high: int) -> np.ndarray:
        """A range of documents times the factor."""
        part = slice(strip.first[low], strip.first[high])
        return np.add.reduceat(strip.table[strip.t[part]] * strip.v[part, None], strip.first[low:high] - strip.first[low], axis=0)

    def both_ways(bundle: Bundle) -> pa.Table:
        """The bundle's matrix times the factor, sent back to its terms; a row without a key is scored but meets no one."""
        adds, unknown = np.zeros_like(bundle.table), np.zeros(bundle.table.shape[1])
        for _, docs, strip in bundle.strips():
            image = np.concatenate([scores(strip, low, high) for low, high in strip.blocks()])
            known = docs.values.is_valid().to_numpy(zero_copy_only=False)
            unknown += image[~known].sum(axis=0)
            image[~known] = 0.0
            adds[strip.at] += np.column_stack([np.bincount(strip.t, strip.v * image[strip.d, j], minlength=len(strip.at)) for j in range(image.shape[1])])
        return bundle.sent(adds, unknown)

    def sums_of_round(table: DataFrame) -> tuple[DataFrame, np.ndarray]:
        """The transposed matrix times the matrix times the factor, and the small matrix of products of the documents' columns."""
        parts, unknown = [], []
        for columns in slices:
            taken = len(range(width)[columns])
            back = packed.passed(table, width, both_ways, ADDS, columns)
            parts.append(cut_lineage(packed.updated(back, table, width, lambda adds, _: adds, lambda _: np.zeros(0), taken)))
            unknown.append(np.resize(own_sum(parts[-1], True), taken) if size[0] else np.zeros(taken))
            sweep(spark)
        beside = parts[0].where(F.col("block") != TOTALS).select("block", F.lit(0).alias("at"), "cells")
        for i, part in enumerate(parts[1:], start=1):
            beside = beside.unionByName(part.where(F.col("block") != TOTALS).select("block", F.lit(i).alias("at"), "cells"))

        def joined(found: pa.Table, blocks: pa.Table) -> pa.Table:
            found = found.sort_by("at")
            sums = np.concatenate([floats(c, len(range(width)[slices[i]])) for i, c in zip(found["at"].to_pylist(), found["cells"])], axis=1)
            return block_row(blocks["block"][0].as_py(), sums, lambda s: floats(blocks["cells"][0], width).T @ s)

        sums = cut_lineage(beside.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(joined, BLOCKS))
        for part in parts:
            release(part)
        products = own_sum(sums).reshape(width, width) if size[1] else np.zeros((width, width))
        outside = np.concatenate(unknown)
        return sums, (products + products.T) / 2 + np.outer(outside, outside)

    def mixed(table: DataFrame, matrix: np.ndarray) -> DataFrame:
        """A factor times a small matrix."""

        def turned(batches):
            for batch in batches:
                for block, cells in zip(batch["block"], batch["cells"]):
                    yield from block_row(block.as_py(), floats(cells, width) @ matrix, own_of).to_batches()

        return cut_lineage(table.select("block", "cells").mapInArrow(turned, BLOCKS), sized=False)

    def orthonormal(products: np.ndarray) -> np.ndarray:
        values, vectors = np.linalg.eigh(products)
        keep = values > values.max(initial=0.0) * 1e-14
        return vectors * np.where(keep, 1 / np.sqrt(np.where(keep, values, 1.0)), 0.0)

    # ``right`` is the transposed matrix times ``left``, which is the matrix times ``before`` times ``basis``.
    residuals = before = basis = None
    for step in range(rounds + (tol > 0)):
        sums, products = sums_of_round(right)
        if tol > 0 and before is not None:
            # With u = left * turn and v = right * turn / s, the vectors A'u and s v are equal, so |Av - su| ** 2 = |Av| ** 2 - s ** 2.
            turned = vectors[:, order]
            lengths = np.einsum("ij,ik,kj->j", turned, products, turned) / np.maximum(singular, TINY) ** 2
            off = np.where(singular > 1e-12 * singular[0], lengths - singular**2, 0.0)
            residuals = (np.sqrt(off.clip(0)) / max(singular[0], TINY))[:k]
            if residuals.max(initial=0.0) <= tol:
                release(sums)
                break
            if step == rounds:
                raise RuntimeError(f"after {rounds} rounds a residual is still {residuals.max():.2g} of the greatest singular value")
        basis, old = orthonormal(products), before
        before, right = right, mixed(sums, basis)
        for done in (sums, old):
            if done is not None:
                release(done)
        sweep(spark)
        gram, column_sums = squares(right)
        values, vectors = np.linalg.eigh(gram)
        order = np.argsort(-values)
        singular = np.sqrt(values[order].clip(0))
    turn = vectors[:, order]
    turn = turn * np.where(column_sums @ turn < 0, -1.0, 1.0)
    last = basis @ (turn * singular)

    def partly(bundle: Bundle) -> pa.Table:
        """Scores by strip, as far as these columns of the factor go."""
        numbers, rows = [], []
        for number, _, strip in bundle.strips():
            numbers.append(number)
            rows.append(np.concatenate([scores(strip, low, high) for low, high in strip.blocks()]))
        return pa.table({"bundle": pa.array([bundle.number] * len(numbers), pa.int64()), "strip": pa.array(numbers, pa.int32()), "cells": binary(rows)})

    scored = []
    for i, columns in enumerate(slices):
        scored.append(cut_lineage(packed.passed(before, width, partly, "bundle long, strip int, cells binary", columns).withColumn("at", F.lit(i))))
        sweep(spark)
    every = scored[0]
    for part in scored[1:]:
        every = every.unionByName(part)

    def of_documents(strips: pa.Table, found: pa.Table) -> pa.Table:
        docs = {s.as_py(): d.values for s, d in zip(strips["strip"], strips["docs"])}
        rows = {s: np.zeros((len(d), width)) for s, d in docs.items()}
        for s, i, cells in zip(found["strip"].to_pylist(), found["at"].to_pylist(), found["cells"]):
            rows[s][:, slices[i]] = floats(cells, len(range(width)[slices[i]]))
        return document_rows(key, [docs[s] for s in rows], [(r @ last)[:, :k] for r in rows.values()])

    doc_schema = T.StructType([T.StructField(key, doc_type), T.StructField("weights", T.ArrayType(T.DoubleType()))])
    docs = cut_lineage(packed.rows.select("bundle", "strip", "docs").groupBy("bundle").cogroup(every.groupBy("bundle")).applyInArrow(of_documents, doc_schema))
    loadings = cut_lineage(packed.term_rows(right, width, lambda rows: (rows @ (turn / np.maximum(singular, TINY)))[:, :k]))
    for done in (before, right, *scored):
        release(done)
    packed.release()
    sweep(spark)
    return Topics(docs, loadings, k, {"singular_values": singular[:k].tolist()} | ({} if residuals is None else {"residuals": residuals.tolist()}))


def _nmf(
    weights: DataFrame, key: str, k: int, max_iter: int, tol: float, seed: int, alpha: float, l1_ratio: float, kl: bool, value: str, start=None
) -> Topics:
    docs, terms, losses = factorise(weights, key, k, max_iter, tol, seed, alpha, l1_ratio, kl, value, start, _start)
    return Topics(docs, terms, k, {"losses": losses})


def topics_nmf(
    weights: DataFrame, key: str, k: int, max_iter: int = 200, tol: float = 1e-4, seed: int = 12345,
    alpha: float = 0.1, l1_ratio: float = 0.5, value: str = "tfidf", start: tuple[Sequence[Column], Sequence[Column]] | None = None,
) -> Topics:
    """Non-negative factors of the long (key, term, value) table, squared loss.

    Each round is one pass over strips of whole documents, which hold the weights of their
    documents and meet the term table's rows for their terms; only k x k products reach the
    driver. ``start``: starting values from the columns ``doc`` and ``term``. ``info["losses"]``
    has the loss before each round, without the penalties.
    """
    return _nmf(weights, key, k, max_iter, tol, seed, alpha, l1_ratio, False, value, start)


def topics_nmf_kl(
    weights: DataFrame, key: str, k: int, max_iter: int = 1000, tol: float = 1e-4, seed: int = 12345,
    alpha: float = 0.1, l1_ratio: float = 0.5, value: str = "tfidf", start: tuple[Sequence[Column], Sequence[Column]] | None = None,
) -> Topics:
    """As ``topics_nmf`` with Kullback-Leibler loss; touches nonzero cells only."""
    return _nmf(weights, key, k, max_iter, tol, seed, alpha, l1_ratio, True, value, start)


def topic_terms(topics: Topics, n: int = 15) -> DataFrame:
    """The heaviest terms of each topic with their place."""
    place = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "term"))
    return topics.terms.withColumn("place", place).filter(F.col("place") <= n).select("topic", "place", "term", "weight")


def topic_assign(docs: DataFrame, key: str, weights: str = "weights") -> DataFrame:
    """Strongest topic of each document, the last one on ties, and its weight."""
    w = F.col(weights)
    last = F.size(w) - F.array_position(F.reverse(w), F.array_max(w))
    return docs.select(key, last.cast("int").alias("topic"), F.array_max(w).alias("prob"), weights)


def prob_columns(docs: DataFrame, k: int, weights: str = "weights", prefix: str = "prob") -> DataFrame:
    """The weights as columns prob1..probK."""
    return docs.select(
        *[c for c in docs.columns if c != weights], *[F.get(F.col(weights), F.lit(j)).alias(f"{prefix}{j + 1}") for j in range(k)]
    )


def topic_counts(assigned: DataFrame, k: int, topic: str = "topic") -> DataFrame:
    """Documents and percent per topic; topics without documents are listed too."""
    spark = assigned.sparkSession
    counted = assigned.groupBy(F.col(topic).cast("int").alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    every = spark.range(k).select(F.col("id").cast("int").alias("topic"))
    total = counted.agg(F.sum("n")).scalar()
    full = every.join(counted, "topic", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return full.withColumn("pct", 100.0 * F.col("n") / F.nullif(total, F.lit(0)))


def topic_profile(table: DataFrame, topic: str, measures: Sequence[str]) -> DataFrame:
    """Mean of each measure, number and percent of rows per topic (or any other group)."""
    return mean_and_count(table, [topic], measures)


@dataclass
class TextClusters:
    docs: DataFrame
    sizes: DataFrame
    terms: DataFrame
    distances: DataFrame


def text_clusters_em(
    docs: DataFrame, key: str, text: str = "text", k: int = 9, min_df: int = 4, dims: int = 20, n_terms: int = 15,
    max_iter: int = 50, seed: int = 12345, **analysis,
) -> TextClusters:
    """Cluster documents by expectation-maximisation on their leading SVD
    scores of IDF weights; describe each cluster by the terms whose mean
    weight is most above the corpus mean."""
    # Counted again for the terms of the clusters: stored, the long table takes several times the bytes of the texts.
    weights = doc_weights(docs, key, text, min_df=min_df, **analysis)
    # Scores that are off by a thousandth of the first direction's length place documents alike.
    found = topics_svd(weights, key, dims, tol=1e-3)
    # Documents without a kept term have no row in the factor and score zero.
    empty = F.array(*[F.lit(0.0)] * found.k)
    every = docs.select(key).join(found.docs, key, "left").select(key, F.coalesce("weights", empty).alias("weights"))
    scores = cut_lineage(every).select(key, array_to_vector("weights").alias("features"))
    model = GaussianMixture(k=k, maxIter=max_iter, seed=seed).fit(scores)
    assigned = model.transform(scores).select(
        key, F.col("prediction").alias("cluster"), F.array_max(vector_to_array("probability")).alias("prob")
    )
    sizes = topic_counts(assigned, k, "cluster").withColumnRenamed("topic", "cluster")
    found_terms = cluster_terms(weights, key, assigned, n_terms)
    distances = centre_distances(docs.sparkSession, [g.mean.toArray() for g in model.gaussians])
    return TextClusters(assigned, sizes, found_terms, distances)


def cluster_terms(weights: DataFrame, key: str, assigned: DataFrame, n_terms: int) -> DataFrame:
    """The terms of each cluster whose mean weight is most above that of all documents, with their place.

    ``assigned`` has every document with its cluster, also those without a term.
    """
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    n_docs = assigned.count()
    placed = weights.filter(F.col("term").isNotNull()).join(assigned.select(key, "cluster"), key).groupBy("cluster", "term").agg(F.sum("value").alias("w"))
    # A term has a row per cluster here. A join with a second aggregate would count the words of all documents again.
    summed = placed.withColumn("all_w", F.sum("w").over(Window.partitionBy("term")))
    lift = (
        summed.join(F.broadcast(sizes), "cluster")
        .select("cluster", "term", (F.col("w") / F.col("n") - F.col("all_w") / n_docs).alias("lift"))
    )
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("lift"), "term"))
    return lift.withColumn("place", place).filter(F.col("place") <= n_terms)


def centre_distances(spark: SparkSession, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Euclidean distance of every pair of cluster centres."""
    points = np.array(centres, dtype=float)
    pairs = [
        (i, j, float(math.sqrt(((points[i] - points[j]) ** 2).sum()))) for i in range(len(points)) for j in range(i + 1, len(points))
    ]
    return spark.createDataFrame(pairs, "a int, b int, distance double")
