"""Row-level regression diagnostics and their summaries."""

from __future__ import annotations

from collections.abc import Sequence
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions import probability
from loomstat.operators.linear import LinearFit, linear_column

# Widest design whose leverage is written out as an expression.
EXPRESSION_WIDTH = 16


def _leverage(fit: LinearFit) -> Column:
    """``1/n + |L'(x - mean)|^2`` with ``L L'`` the inverse scatter matrix."""
    values, vectors = np.linalg.eigh(fit.inverse)
    root = vectors * np.sqrt(np.clip(values, 0.0, None))
    if fit.p <= EXPRESSION_WIDTH:
        out = F.lit(1.0 / fit.n)
        centred = [F.col(f"`{c}`") - F.lit(float(m)) for c, m in zip(fit.xs, fit.means)]
        for k in range(fit.p):
            part = F.lit(0.0)
            for j in range(fit.p):
                part = part + F.lit(float(root[j, k])) * centred[j]
            out = out + part * part
        return out
    means, n = fit.means, fit.n

    @F.pandas_udf("double")
    def quadratic(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns]) - means
        return pd.Series(1.0 / n + ((x @ root) ** 2).sum(axis=1))

    return quadratic(*[F.col(f"`{c}`") for c in fit.xs])


def influence(df: DataFrame, fit: LinearFit, keep: Sequence[str]) -> DataFrame:
    """Per row: observed, predicted, residual, standardised residual, leverage,
    internally studentised residual and Cook's distance.

    Needs no shuffle: only the fitted matrix travels, as literals.
    """
    scale = math.sqrt(fit.mse)
    base = df.select(
        *keep, F.col(f"`{fit.y}`").cast("double").alias("observed"), linear_column(fit).alias("predicted"), _leverage(fit).alias("leverage")
    )
    residual = F.col("observed") - F.col("predicted")
    with_res = base.select("*", residual.alias("residual"), (residual / scale).alias("standardized"))
    student = F.col("standardized") / F.sqrt(1.0 - F.col("leverage"))
    with_student = with_res.select("*", student.alias("studentized"))
    cook = F.col("studentized") ** 2 * F.col("leverage") / (1.0 - F.col("leverage")) / (fit.p + 1)
    return with_student.select("*", cook.alias("cooks_d"))


def influence_cutoffs(rows: DataFrame, n: int, p: int) -> DataFrame:
    """Largest Cook's distance against 4/n, largest leverage against 2(p+2)/n."""
    d_cut, h_cut = 4.0 / n, 2.0 * (p + 2) / n
    return rows.agg(
        F.max("cooks_d").alias("max_cooks_d"),
        F.lit(d_cut).alias("cooks_d_cutoff"),
        F.count_if(F.col("cooks_d") > d_cut).alias("n_over_cooks_d"),
        F.max("leverage").alias("max_leverage"),
        F.lit(h_cut).alias("leverage_cutoff"),
        F.count_if(F.col("leverage") > h_cut).alias("n_over_leverage"),
    )


def sigma_expectation(rows: DataFrame, n: int, sigmas: Sequence[int] = (3, 4, 5, 6), measure: str = "studentized") -> DataFrame:
    """Rows expected and seen beyond each number of standard deviations."""
    counts = [F.count_if(F.abs(measure) > s).alias(f"s{s}") for s in sigmas]
    cells = [
        F.struct(
            F.lit(s).alias("sigma"),
            F.lit(int(round(n * probability.normal_two_sided(s)))).cast("bigint").alias("expected"),
            F.col(f"s{s}").alias("observed"),
        )
        for s in sigmas
    ]
    return rows.agg(*counts).select(F.inline(F.array(*cells)))


def residual_outliers(rows: DataFrame, key: Sequence[str], sigma: float = 4.0, first: int | None = 15) -> DataFrame:
    """Rows beyond ``sigma`` studentised residuals; the first few by key, or all."""
    out = rows.filter(F.abs("studentized") > sigma).select(*key, "observed", "predicted", "studentized")
    return out.orderBy(*key).limit(first) if first is not None else out


MEASURES = ("observed", "predicted", "residual", "standardized", "studentized", "cooks_d")


def diag_summary(rows: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Minimum, mean and maximum of each diagnostic, one pass."""
    aggs = [f(m).alias(f"{m}_{n}") for m in measures for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    cells = [
        F.struct(
            F.lit(m).alias("measure"),
            F.col(f"{m}_min").alias("min"),
            F.col(f"{m}_mean").alias("mean"),
            F.col(f"{m}_max").alias("max"),
        )
        for m in measures
    ]
    return rows.agg(*aggs).select(F.inline(F.array(*cells)))


def top_observed(rows: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """The rows with the largest observed value and their prediction."""
    chosen = rows.select(*key, "observed", "predicted", "residual")
    return chosen.orderBy(F.desc("observed"), *key).limit(n)
