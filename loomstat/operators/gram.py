"""Cross-product matrix of a design in one pass over the rows.

Everything linear (least squares, Lasso paths, stepwise and genetic search,
metrics on another split) is then arithmetic on this small matrix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Up to this many columns the products are plain SQL sums in one generated
# aggregate; wider designs use one matrix product per Arrow batch.
SQL_WIDTH = 8


@dataclass
class Gram:
    """Moments of ``[1, x - origin, y - origin]``; the last column is the target."""

    xs: list[str]
    y: str
    origin: np.ndarray
    moments: np.ndarray

    @property
    def n(self) -> int:
        return int(round(self.moments[0, 0]))

    @property
    def p(self) -> int:
        return len(self.xs)

    @property
    def means(self) -> np.ndarray:
        return self.origin + self.moments[0, 1:] / self.moments[0, 0]

    @property
    def scatter(self) -> np.ndarray:
        """Sums of products about the means."""
        first = self.moments[0, 1:]
        return self.moments[1:, 1:] - np.outer(first, first) / self.moments[0, 0]

    @property
    def raw(self) -> np.ndarray:
        """Uncentred ``[1 x y]'[1 x y]``."""
        back = np.eye(len(self.origin) + 1)
        back[0, 1:] = self.origin
        return back.T @ self.moments @ back

    def __add__(self, other: "Gram") -> "Gram":
        if not np.array_equal(self.origin, other.origin):
            raise ValueError("different origins")
        return Gram(self.xs, self.y, self.origin, self.moments + other.moments)

    def sse(self, intercept: float, coef: np.ndarray) -> float:
        """Squared error of any linear model on these rows, without reading them again."""
        step = np.concatenate(([intercept + coef @ self.origin[:-1] - self.origin[-1]], coef, [-1.0]))
        return float(max(step @ self.moments @ step, 0.0))

    @property
    def sst(self) -> float:
        return float(self.scatter[-1, -1])


def _origin(data: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Column means over all rows: products about them lose no digits, however the table is sorted."""
    row = data.agg(*[F.avg(F.nanvl(c, F.lit(None))) for c in columns]).first()
    return np.array([v if v is not None else 0.0 for v in row], dtype=float)


def _by_sums(data: DataFrame, columns: Sequence[str], origin: np.ndarray) -> dict:
    terms = [F.lit(1.0)] + [F.col(c) - F.lit(float(o)) for c, o in zip(columns, origin)]
    size = len(terms)
    cells = [(i, j) for i in range(size) for j in range(i, size)]
    rows = data.dropna().groupBy("_split").agg(*[F.sum(terms[i] * terms[j]).alias(f"c{i}_{j}") for i, j in cells]).collect()
    out = {}
    for row in rows:
        matrix = np.zeros((size, size))
        for i, j in cells:
            matrix[i, j] = matrix[j, i] = row[f"c{i}_{j}"]
        out[row["_split"]] = matrix
    return out


def _by_batches(data: DataFrame, columns: Sequence[str], origin: np.ndarray) -> dict:
    size = len(columns) + 1
    upper = np.triu_indices(size)

    def partial(batches):
        total: dict = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            coded = batch.column(0).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            design = np.ones((batch.num_rows, size))
            for k in range(1, size):
                design[:, k] = batch.column(k).to_numpy(zero_copy_only=False) - origin[k - 1]
            complete = ~np.isnan(design).any(axis=1)
            for code, label in enumerate(coded.dictionary.to_pylist()):
                rows = design[complete & (codes == code)]
                total[label] = total.get(label, 0.0) + rows.T @ rows
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([m[upper].tolist() for m in total.values()], pa.list_(pa.float64()))],
                names=["split", "cells"],
            )

    parts = data.select("_split", *columns).mapInArrow(partial, "split string, cells array<double>")
    sums = (
        parts.select("split", F.posexplode("cells").alias("pos", "value"))
        .groupBy("split", "pos")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    out: dict = {}
    for row in sums:
        matrix = out.setdefault(row.split, np.zeros((size, size)))
        i, j = upper[0][row.pos], upper[1][row.pos]
        matrix[i, j] = matrix[j, i] = row.value
    return out


def grams(df: DataFrame, xs: Sequence[str], y: str, split: str | None = None) -> dict[str, Gram]:
    """One Gram per level of ``split`` (train/validation, folds), in one pass.

    Rows with a missing value in any used column are left out.
    """
    columns = [*xs, y]
    label = F.col(f"`{split}`").cast("string") if split else F.lit("all")
    # Encoded names such as "cut0:Fair" stay out of the generated code.
    names = [f"c{i}" for i in range(len(columns))]
    data = df.select(
        F.coalesce(label, F.lit("")).alias("_split"),
        *[F.col(f"`{c}`").cast("double").alias(a) for c, a in zip(columns, names)],
    )
    origin = _origin(data, names)
    build = _by_sums if len(columns) <= SQL_WIDTH else _by_batches
    return {s: Gram(list(xs), y, origin, m) for s, m in build(data, names, origin).items()}


def gram(df: DataFrame, xs: Sequence[str], y: str) -> Gram:
    found = grams(df, xs, y)
    if not found:
        raise ValueError("no complete row to fit on")
    return found["all"]


def gram_table(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """The uncentred matrix as rows (row_term, col_term, value), upper triangle."""
    names = ["const", *xs, y]
    data = df.select(*[F.col(c).cast("double").alias(c) for c in names[1:]]).dropna()
    columns = {"const": F.lit(1.0), **{c: F.col(c) for c in names[1:]}}
    cells = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = data.agg(*[F.sum(columns[a] * columns[b]).alias(f"v{k}") for k, (a, b) in enumerate(cells)])
    rows = [
        F.struct(F.lit(a).alias("row_term"), F.lit(b).alias("col_term"), F.col(f"v{k}").alias("value"))
        for k, (a, b) in enumerate(cells)
    ]
    return sums.select(F.inline(F.array(*rows)))


def gram_cells(spark: SparkSession, g: Gram) -> DataFrame:
    """The uncentred matrix of a Gram as ``gram_table`` has it; moved back from its origin, so to about 13 digits."""
    names, raw = ["const", *g.xs, g.y], g.raw
    rows = [(a, names[j], float(raw[i, j])) for i, a in enumerate(names) for j in range(i, len(names))]
    return spark.createDataFrame(rows, "row_term string, col_term string, value double")
