"""Non-negative factors of a long (key, term, value) table by multiplicative updates.

The cells are packed once into bundles of whole documents. The weights of documents
lie by strip, so a round takes a single pass: every bundle meets the
rows of the term factor that it has cells of, updates its documents, and sends
what its cells add to those terms. Neither factor has to fit on one machine,
and the cells never move again. The loss of a round comes with the next pass.
"""

from __future__ import annotations

from collections.abc import Sequence
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.operators.bundles import ADDS, TOTALS, Bundle, Bundles, Strip, binary, floats, own_sum, total_of
from loomstat.operators.strips import list_rows, sum_by
from loomstat.session import cut_lineage, release, sweep

TINY = 1e-12
# Cells of a strip, about.
STRIP_CELLS = 1_000_000


def round_of(kl: bool, strip: Strip, w: np.ndarray, below: np.ndarray, l1: float, l2: float):
    """New document weights of a strip, what it adds to its terms, and its part of the loss before the round.

    ``below``: column sums of the term factor (Kullback-Leibler) or its matrix of products (squared).
    """
    new, adds, loss = np.empty_like(w), np.zeros_like(strip.table), 0.0
    for low, high in strip.blocks():
        part = slice(strip.first[low], strip.first[high])
        d, v, own = strip.d[part] - low, strip.v[part], w[low:high]
        h = strip.table[strip.t[part]]

        def guess(rows: np.ndarray) -> np.ndarray:
            return np.einsum("ij,ij->i", rows[d], h)

        if kl:
            share = v / (guess(own) + TINY)
            loss += float((v * np.log(np.maximum(share, TINY))).sum() - v.sum())
        else:
            share = v
            loss += float(0.5 * (v * v).sum() - (v * guess(own)).sum())
        under = below if kl else own @ below
        over = np.add.reduceat(h * share[:, None], strip.first[low:high] - strip.first[low], axis=0)
        found = new[low:high] = own * over / (under + l1 + l2 * own + TINY)
        share = v / (guess(found) + TINY) if kl else v
        adds += sum_by(strip.t[part], found[d] * share[:, None], len(adds))
    return new, adds, loss


def factorise(
    weights: DataFrame, key: str, k: int, max_iter: int, tol: float, seed: int, alpha: float, l1_ratio: float, kl: bool, value: str,
    start: tuple[Sequence[Column], Sequence[Column]] | None = None, keyed_start=None,
) -> tuple[DataFrame, DataFrame, list[float]]:
    """(key, weights) per document, (topic, term, weight) rows, and the loss before each round.

    Cells that are not positive are left out. The search ends when a round changes
    the loss by at most ``tol`` of the first one, or after ``max_iter``. ``start`` gives starting values from
    the columns ``doc`` and ``term`` in place of those that ``keyed_start`` draws.
    """
    spark = weights.sparkSession
    cells = weights.select(F.col(key).alias("doc"), F.col("term"), F.col(value).cast("double").alias("v")).where("v > 0")
    packed = Bundles(cells, k, STRIP_CELLS)
    doc_type = weights.schema[key].dataType
    if not packed.n_docs:
        packed.release()
        none = spark.createDataFrame([], T.StructType([T.StructField(key, doc_type), T.StructField("weights", T.ArrayType(T.DoubleType()))]))
        return none, spark.createDataFrame([], "topic int, term string, weight double"), []
    level = math.sqrt(packed.volume / packed.n_docs / packed.n_terms / k)
    w_start, h_start = start or (keyed_start("doc", "w", k, seed, level), keyed_start("term", "h", k, seed + 1, level))
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)

    def own_of(h: np.ndarray) -> np.ndarray:
        """What a round needs of the whole term factor: its column sums (Kullback-Leibler) or its matrix of products."""
        return h.sum(axis=0) if kl else (h.T @ h).ravel()

    h = packed.factor(h_start, own_of)
    # The documents' weights: the start, then what the last pass gave.
    state = stored = packed.documents_state(w_start)

    def passed(under: np.ndarray):
        def work(bundle: Bundle) -> pa.Table:
            adds, sums, numbers, found = np.zeros_like(bundle.table), 0.0, [], []
            for number, _, strip in bundle.strips():
                w = floats(bundle.states[number], k)
                new, own, loss = round_of(kl, strip, w, under, l1, l2)
                adds[strip.at] += own
                # What the loss and the other update need of all documents: before the round, and after it.
                sums = sums + np.concatenate([[loss], *([w.sum(axis=0), new.sum(axis=0)] if kl else [(w.T @ w).ravel(), (new.T @ new).ravel()])])
                numbers.append(number)
                found.append(new)
            out, n = bundle.sent(adds, sums), len(numbers)
            terms = out.append_column("bundle", pa.nulls(len(out), pa.int64())).append_column("strip", pa.nulls(len(out), pa.int32()))
            docs = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), binary(found), pa.array([bundle.number] * n, pa.int64()), pa.array(numbers, pa.int32())]
            return pa.concat_tables([terms, pa.table(docs, schema=terms.schema)])

        return work

    losses: list[float] = []
    for _ in range(max_iter):
        under = own_sum(h)
        under = under if kl else under.reshape(k, k)
        out = cut_lineage(packed.passed(h, k, passed(under), f"{ADDS}, bundle long, strip int", state=state), sized=False)
        total = total_of(out.where(F.col("block") == TOTALS).select("sums").toArrow()["sums"])  # 1 + 2k or 1 + 2kk numbers
        before, after = np.split(total[1:], 2)
        volume = float((before * under.ravel()).sum())
        losses.append(float(total[0] + (volume if kl else 0.5 * volume)))
        if len(losses) > 1 and abs(losses[-2] - losses[-1]) <= tol * max(abs(losses[0]), TINY):
            release(out)
            break

        def update(adds: np.ndarray, old: np.ndarray, after: np.ndarray = after) -> np.ndarray:
            divisor = after if kl else old @ after.reshape(k, k)
            return old * adds / (divisor + l1 + l2 * old + TINY)

        adds = out.where(F.col("block") != TOTALS).select("block", "idx", "sums")
        next_h = cut_lineage(packed.updated(adds, h, k, update, own_of), sized=False)
        for old in (h, stored):
            release(old)
        h, stored = next_h, out
        state = out.where("block is null").select("bundle", "strip", F.col("sums").alias("cells"))
        sweep(spark)

    def of_documents(strips: pa.Table, states: pa.Table) -> pa.Table:
        weights_of = dict(zip(states["strip"].to_pylist(), states["cells"]))
        docs = [d.values for d in strips["docs"]]
        found = [floats(weights_of[s], k) for s in strips["strip"].to_pylist()]
        return pa.table([pa.concat_arrays(docs), list_rows(np.concatenate(found))], names=[key, "weights"])

    schema = T.StructType([T.StructField(key, doc_type), T.StructField("weights", T.ArrayType(T.DoubleType()))])
    strips = packed.rows.select("bundle", "strip", "docs")
    docs = cut_lineage(strips.groupBy("bundle").cogroup(state.groupBy("bundle")).applyInArrow(of_documents, schema))
    terms = cut_lineage(packed.term_rows(h, k, lambda rows: rows))
    for old in (h, stored):
        release(old)
    packed.release()
    sweep(spark)
    return docs, terms, losses
