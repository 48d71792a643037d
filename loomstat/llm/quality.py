"""Text quality by a regularised quadratic discriminant.

Every document becomes a row of statistics, transformed (logs and log-odds) so
that each class looks like one normal cloud. The covariance of a class is drawn
towards the pooled one and towards its diagonal; how far is chosen by
cross-validated log-loss. A score is the posterior that follows from the
difference of the two log-densities, whose Mahalanobis distances come from
Cholesky factors that are worked out once.
"""

from __future__ import annotations

import math
import operator
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import held_out
from loomstat.session import cut_lineage

# Kinds of characters.
OTHER, SPACE, LINE, UPPER, LOWER, DIGIT, MARK = range(7)
STATISTICS = [
    "words", "word_length", "upper", "digits", "marks", "mark_runs", "distinct_words", "top_word",
    "repeated_words", "lone_marks", "repeated_lines", "repeated_sentences", "compressed", "line_length", "other",
]
# How far a class covariance is drawn to the pooled one, and the result to its diagonal.
POOLINGS = (0.0, 0.1, 0.3, 0.6, 1.0)
DIAGONALS = (0.001, 0.05, 0.2)
FOLDS = 5
# Least variance of a statistic, so that one that never changes does no harm.
LEAST_VARIANCE = 1e-6


@cache
def character_kinds() -> np.ndarray:
    """Kind of each character of the basic plane; all others count as OTHER."""

    def kind(i: int) -> int:
        category = unicodedata.category(chr(i))
        if i == 10:
            return LINE
        if category[0] == "Z" or i in (9, 11, 12, 13):
            return SPACE
        if category in ("Lu", "Lt"):
            return UPPER
        return {"L": LOWER, "N": DIGIT, "P": MARK, "S": MARK}.get(category[0], OTHER)

    return np.array([kind(i) for i in range(1 << 16)] + [OTHER], dtype=np.uint8)


def log_odds(part: float, whole: float) -> float:
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of STATISTICS."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    kinds = character_kinds()[np.minimum(points, 1 << 16)]
    n = np.bincount(kinds, minlength=7).tolist()
    visible = len(points) - n[SPACE] - n[LINE]
    marks = kinds == MARK
    words = text.split()
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    sentences = text.replace("\n", " ").split(". ")
    raw = text.encode()
    return [
        math.log1p(len(words)),
        visible / max(len(words), 1),
        log_odds(n[UPPER], n[UPPER] + n[LOWER]),
        log_odds(n[DIGIT], visible),
        log_odds(n[MARK], visible),
        log_odds(int(np.count_nonzero(marks[1:] & marks[:-1])), n[MARK]),
        log_odds(len(counts), len(words)),
        log_odds(max(counts.values(), default=0), len(words)),
        log_odds(sum(map(operator.eq, words, words[1:])), len(words)),
        log_odds(sum(times for w, times in counts.items() if not any(map(str.isalnum, w))), len(words)),
        log_odds(len(lines) - len(set(lines)), len(lines)),
        log_odds(len(sentences) - len(set(sentences)), len(sentences)),
        math.log(0.01 + len(zlib.compress(raw, 1)) / (len(raw) + 20)),
        math.log((len(words) + 1) / (len(lines) + 1)),
        log_odds(n[OTHER], len(points)),
    ]


def statistics_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, stats)."""
    for batch in batches:
        rows = [statistics(t.as_py() or "") for t in batch.column(1)]
        flat = np.array(rows, dtype=np.float64).reshape(-1)
        ends = np.arange(0, len(flat) + 1, len(STATISTICS), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "stats"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every row, stored; null texts count as empty."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut_lineage(texts.mapInArrow(statistics_batches, "doc_id long, stats array<double>"))


@dataclass(frozen=True)
class Moments:
    """Rows, sums and sums of products of one class."""

    n: float
    total: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.total + other.total, self.products + other.products)

    @property
    def mean(self) -> np.ndarray:
        return self.total / self.n

    @property
    def covariance(self) -> np.ndarray:
        return self.products / self.n - np.outer(self.mean, self.mean)


NOTHING = Moments(0.0, np.zeros(len(STATISTICS)), np.zeros((len(STATISTICS), len(STATISTICS))))


def moments(rows: DataFrame) -> dict[tuple[int, int], Moments]:
    """Moments of each (fold, label) from (fold, label, stats): one aggregate, summed before the shuffle."""
    p = len(STATISTICS)
    stat = [F.col("stats")[i] for i in range(p)]
    cells = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.sum(s).alias(f"s{i}") for i, s in enumerate(stat)] + [F.sum(stat[i] * stat[j]).alias(f"p{i}_{j}") for i, j in cells]
    out = {}
    for row in rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # at most 2 * FOLDS rows
        products = np.zeros((p, p))
        for i, j in cells:
            products[i, j] = products[j, i] = row[f"p{i}_{j}"]
        out[row["fold"], row["label"]] = Moments(float(row["n"]), np.array([row[f"s{i}"] for i in range(p)]), products)
    return out


@dataclass(frozen=True)
class Discriminant:
    """Per class, its mean, inverse Cholesky factor and constant of the log-density; ``share`` of label 1 alone where a class has no rows."""

    share: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    constants: np.ndarray | None = None

    def margins(self, stats: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for each row of statistics."""
        if self.means is None:
            odds = min(max(self.share, 1e-6), 1 - 1e-6)
            return np.full(len(stats), math.log(odds / (1 - odds)))
        density = [self.constants[k] - 0.5 * np.square((stats - self.means[k]) @ self.factors[k].T).sum(axis=1) for k in (0, 1)]
        return density[1] - density[0]

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(stats), -30.0, 30.0)))


def discriminant(by_class: list[Moments], pooling: float, diagonal: float) -> Discriminant:
    """The discriminant of two classes' moments; the same rows give the same factors."""
    rows = by_class[0].n + by_class[1].n
    share = by_class[1].n / rows if rows else 0.5
    if not by_class[0].n or not by_class[1].n:
        return Discriminant(share)
    pooled = sum(m.n * m.covariance for m in by_class) / rows
    spread = np.diag(np.maximum(np.diag(pooled), LEAST_VARIANCE))
    factors, constants = [], []
    for m in by_class:
        drawn = (1 - pooling) * m.covariance + pooling * pooled
        factor = np.linalg.cholesky((1 - diagonal) * drawn + diagonal * spread + LEAST_VARIANCE * np.eye(len(spread)))
        factors.append(np.linalg.inv(factor))
        constants.append(math.log(m.n / rows) - np.log(np.diag(factor)).sum())
    return Discriminant(share, np.array([m.mean for m in by_class]), np.array(factors), np.array(constants))


def fold_losses(models: dict[int, list[Discriminant]]):
    """(fold, label, stats) to the summed log-loss of each setting, every row judged by the models that have not seen its fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(POOLINGS) * len(DIAGONALS))
        for batch in batches:
            fold, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            stats = batch.column(2).flatten().to_numpy().reshape(-1, len(STATISTICS))
            for k, settings in models.items():
                own = fold == k
                sign = np.where(label[own] == 1, -1.0, 1.0)
                for i, model in enumerate(settings):
                    sums[i] += np.logaddexp(0.0, sign * model.margins(stats[own])).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["setting", "loss"])

    return run


def fit(stats: DataFrame, labels: DataFrame) -> Discriminant:
    """The discriminant of the rows of ``stats`` that have a label and are not held out.

    ``stats`` comes from :func:`document_statistics`; ``labels`` has doc_id and
    quality. Labels other than 0 and 1 are ignored; a doc_id with both counts as 0.
    Rows whose crc32(doc_id as text) is a multiple of five are never read. All other
    labelled rows are, each as often as it occurs; without rows of both classes
    the model is the share of label 1 (0.5 without any).
    """
    known = labels.select(F.col("doc_id").cast("long").alias("of"), F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    known = known.where(~held_out(F.col("of"), 5, 0)).groupBy("of").agg(F.min("label").alias("label"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id")), F.lit(FOLDS)).cast("int").alias("fold")
    rows = cut_lineage(stats.join(known, F.col("doc_id") == F.col("of")).select(fold, "label", "stats"))
    found = moments(rows)

    def classes(but: int | None = None) -> list[Moments]:
        return [sum((found.get((f, label), NOTHING) for f in range(FOLDS) if f != but), NOTHING) for label in (0, 1)]

    settings = list(product(POOLINGS, DIAGONALS))
    models = {f: [discriminant(classes(f), *s) for s in settings] for f in range(FOLDS)}
    losses = rows.mapInArrow(fold_losses(models), "setting long, loss double").groupBy("setting").agg(F.sum("loss").alias("loss")).collect()
    best = min(((row["loss"], row["setting"]) for row in losses), default=(0.0, 0))[1]
    return discriminant(classes(), *settings[best])


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) of every row of ``stats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(rows))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the posterior of label 1.

    ``docs`` needs ``doc_id`` and ``text``; other columns, whatever their names, are
    not read. Null texts count as empty and are scored by the statistics of an empty text;
    texts of any length are read whole; repeated rows get equal scores; a null
    doc_id stays null and has no label; an empty table gives no rows. Ids are cast
    to long, so text ids fail.
    """
    stats = document_statistics(docs)
    return score(stats, fit(stats, labels))
