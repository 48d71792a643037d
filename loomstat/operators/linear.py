"""Least squares, Lasso and elastic-net paths, information criteria and metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomstat.functions import probability
from loomstat.operators.gram import Gram, gram, grams
from loomstat.operators.quantile import exact_medians, with_range_bucket


def spd_inverse(matrix: np.ndarray, tol: float = 1e-11) -> tuple[np.ndarray, int]:
    """(Pseudo-)inverse of a scatter block and its rank. Columns are scaled to
    unit length first; directions below ``tol`` count as collinear."""
    if matrix.shape[0] == 0:
        return matrix.copy(), 0
    d = np.sqrt(np.clip(np.diag(matrix), 0.0, None))
    d[d == 0.0] = 1.0
    values, vectors = np.linalg.eigh(matrix / np.outer(d, d))
    good = values > tol * max(values[-1], 1.0)
    inverse = (vectors[:, good] / values[good]) @ vectors[:, good].T
    return inverse / np.outer(d, d), int(good.sum())


def info_criteria(ll: float, n: int, p: int, n_cat: int = 2) -> dict[str, float]:
    """AIC, AICc and BIC. Parameters counted: ``p`` + 2, or for a multinomial
    target ``n_cat * (p + 1) + 1``."""
    k = p + 2 if n_cat <= 2 else n_cat * (p + 1) + 1
    aic = -2.0 * ll + 2.0 * k
    room = n - k - 1
    return {
        "aic": aic,
        "aicc": aic + 2.0 * k * (k + 1) / room if room > 0 else math.inf,
        "bic": -2.0 * ll + k * math.log(n),
    }


def gaussian_ll(sse: float, n: int) -> float:
    """Log-likelihood of a normal model at its own error variance."""
    return -n / 2.0 * (math.log(2.0 * math.pi) + 1.0 + math.log(sse / n)) if sse > 0 else math.inf


@dataclass
class LinearFit:
    xs: list[str]
    y: str
    n: int
    intercept: float
    coef: np.ndarray
    means: np.ndarray
    inverse: np.ndarray
    rank: int
    sse: float
    sst: float

    @property
    def p(self) -> int:
        return len(self.xs)

    @property
    def df_error(self) -> int:
        return self.n - self.rank - 1

    @property
    def mse(self) -> float:
        return self.sse / self.df_error

    @property
    def r2(self) -> float:
        return 1.0 - self.sse / self.sst

    @property
    def adj_r2(self) -> float:
        return 1.0 - (1.0 - self.r2) * (self.n - 1) / self.df_error

    @property
    def ll(self) -> float:
        return gaussian_ll(self.sse, self.n)

    @property
    def std_err(self) -> np.ndarray:
        """Of the intercept, then of the slopes."""
        slopes = np.diag(self.inverse)
        const = 1.0 / self.n + self.means @ self.inverse @ self.means
        return np.sqrt(self.mse * np.concatenate(([const], slopes)))

    @property
    def t_values(self) -> np.ndarray:
        return np.concatenate(([self.intercept], self.coef)) / self.std_err


def ols_from_gram(g: Gram, columns: Sequence[int] | None = None) -> LinearFit:
    """Least squares on any subset of the columns a Gram holds."""
    idx = list(range(g.p)) if columns is None else list(columns)
    scatter = g.scatter
    inverse, rank = spd_inverse(scatter[np.ix_(idx, idx)])
    coef = inverse @ scatter[idx, -1]
    means = g.means
    sse = float(scatter[-1, -1] - coef @ scatter[idx, -1])
    return LinearFit(
        [g.xs[i] for i in idx], g.y, g.n, float(means[-1] - means[idx] @ coef), coef, means[idx], inverse, rank,
        max(sse, 0.0), float(scatter[-1, -1]),
    )


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> LinearFit:
    return ols_from_gram(gram(df, xs, y))


def coefficient_table(spark: SparkSession, fit: LinearFit, level: float = 0.95) -> DataFrame:
    """Coefficient, standard error, t, p and confidence limits per term."""
    q = probability.student_quantile(0.5 + level / 2.0, fit.df_error)
    values = np.concatenate(([fit.intercept], fit.coef))
    rows = [
        (i, name, float(b), float(s), float(t), probability.student_two_sided(float(t), fit.df_error), float(b - q * s), float(b + q * s))
        for i, (name, b, s, t) in enumerate(zip(["const", *fit.xs], values, fit.std_err, fit.t_values))
    ]
    return spark.createDataFrame(
        rows, "position int, term string, coef double, std_err double, t double, p_value double, low double, high double"
    )


def fit_summary(spark: SparkSession, fit: LinearFit) -> DataFrame:
    """One row: n, degrees of freedom, R2, F test, log-likelihood, criteria."""
    f = (fit.sst - fit.sse) / fit.rank / fit.mse if fit.rank else 0.0
    ic = info_criteria(fit.ll, fit.n, fit.p)
    row = (
        fit.n, fit.rank, fit.df_error, fit.r2, fit.adj_r2, f,
        probability.f_upper(f, fit.rank, fit.df_error) if fit.rank else 1.0, fit.ll, ic["aic"], ic["aicc"], ic["bic"],
    )
    return spark.createDataFrame(
        [row],
        "n bigint, df_model int, df_error bigint, r2 double, adj_r2 double, f double, f_p double, ll double, "
        "aic double, aicc double, bic double",
    )


def strongest_attribute(coefficients: DataFrame) -> DataFrame:
    """The term, other than the constant, with the largest absolute t."""
    ranked = coefficients.filter(F.col("term") != "const").withColumn("abs_t", F.abs("t"))
    return ranked.orderBy(F.desc("abs_t"), "position").limit(1).select("term", "t", "abs_t")


def linear_column(fit: LinearFit) -> Column:
    """The fitted value as a column expression."""
    out = F.lit(float(fit.intercept))
    for name, b in zip(fit.xs, fit.coef):
        if b != 0.0:
            out = out + F.lit(float(b)) * F.col(f"`{name}`")
    return out


def predict(df: DataFrame, fit: LinearFit, out: str = "predicted") -> DataFrame:
    return df.withColumn(out, linear_column(fit))


def regression_metrics(scored: DataFrame, actual: str, predicted: str, p: int, split: str) -> DataFrame:
    """Fit measures per split. Sums come from one aggregate; the median
    absolute error is exact and found by histogram refinement."""
    rows = scored.select(
        F.col(split).alias(split), F.col(actual).alias("_a"), (F.col(actual) - F.col(predicted)).alias("_e")
    ).dropna()
    medians = exact_medians(rows.withColumn("_ae", F.abs("_e")), "_ae", split)
    table = scored.sparkSession.createDataFrame(
        [(str(s), m) for s, m in medians.items()], f"`{split}` string, median_ae double"
    )
    n, sse = F.col("n"), F.col("sse")
    k = p + 2
    sums = rows.groupBy(F.col(split).cast("string").alias(split)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_e") * F.col("_e")).alias("sse"),
        F.avg(F.abs("_e")).alias("mean_ae"),
        (F.var_pop("_a") * F.count(F.lit(1))).alias("sst"),
    )
    with_fit = sums.select(
        split,
        "n",
        F.lit(p + 1).alias("n_coef"),
        (n - (p + 1)).alias("df_error"),
        (1.0 - sse / F.nullif("sst", F.lit(0.0))).alias("r2"),
        "mean_ae",
        (sse / n).alias("ase"),
        F.sqrt(sse / n).alias("root_ase"),
        (-n / 2.0 * (F.log(F.lit(2.0 * math.pi)) + 1.0 + F.log(F.nullif(sse, F.lit(0.0)) / n))).alias("ll"),
    )
    ll = F.col("ll")
    full = with_fit.select(
        "*",
        (1.0 - (1.0 - F.col("r2")) * (n - 1) / F.nullif(F.col("df_error"), F.lit(0))).alias("adj_r2"),
        (-2.0 * ll + 2.0 * k).alias("aic"),
        (-2.0 * ll + 2.0 * k + 2.0 * k * (k + 1) / F.nullif(n - k - 1, F.lit(0))).alias("aicc"),
        (-2.0 * ll + k * F.log(n)).alias("bic"),
    )
    return full.join(F.broadcast(table), split)


def adj_r2_prob(scored: DataFrame, label: str, prob: str, p: int) -> DataFrame:
    """R2 and adjusted R2 of a 0/1 label on a probability, not below 0."""
    sums = scored.agg(
        F.count(label).alias("n"),
        F.sum((F.col(label) - F.col(prob)) * (F.col(label) - F.col(prob))).alias("sse"),
        (F.var_pop(label) * F.count(label)).alias("sst"),
    )
    r2 = 1.0 - F.col("sse") / F.nullif("sst", F.lit(0.0))
    adjusted = 1.0 - (1.0 - r2) * (F.col("n") - 1) / F.nullif(F.col("n") - p - 1, F.lit(0))
    return sums.select("n", r2.alias("r2"), F.greatest(adjusted, F.lit(0.0)).alias("adj_r2"))


def _chebyshev_normal(n: int, skew: float, kurt: float) -> tuple[float, float]:
    """D'Agostino-Pearson omnibus statistic and its p-value."""
    y = skew * math.sqrt((n + 1.0) * (n + 3.0) / (6.0 * (n - 2.0)))
    beta2 = 3.0 * (n * n + 27.0 * n - 70.0) * (n + 1.0) * (n + 3.0) / ((n - 2.0) * (n + 5.0) * (n + 7.0) * (n + 9.0))
    w2 = -1.0 + math.sqrt(2.0 * (beta2 - 1.0))
    alpha = math.sqrt(2.0 / (w2 - 1.0))
    z_skew = math.asinh(y / alpha) / math.sqrt(0.5 * math.log(w2))
    mean = 3.0 * (n - 1.0) / (n + 1.0)
    var = 24.0 * n * (n - 2.0) * (n - 3.0) / ((n + 1.0) ** 2 * (n + 3.0) * (n + 5.0))
    x = (kurt - mean) / math.sqrt(var)
    root = (
        6.0 * (n * n - 5.0 * n + 2.0) / ((n + 7.0) * (n + 9.0))
        * math.sqrt(6.0 * (n + 3.0) * (n + 5.0) / (n * (n - 2.0) * (n - 3.0)))
    )
    a = 6.0 + 8.0 / root * (2.0 / root + math.sqrt(1.0 + 4.0 / root**2))
    base = (1.0 - 2.0 / a) / (1.0 + x * math.sqrt(2.0 / (a - 4.0)))
    z_kurt = (1.0 - 2.0 / (9.0 * a) - math.copysign(abs(base) ** (1.0 / 3.0), base)) / math.sqrt(2.0 / (9.0 * a))
    k2 = z_skew**2 + z_kurt**2
    return k2, probability.chi2_upper(k2, 2)


# Rows per ordered range when neighbours are compared, and most ranges used.
RANGE_ROWS = 1_000_000
MAX_RANGES = 10_000


def durbin_watson(df: DataFrame, residual: str, order: str, buckets: int | None = None) -> DataFrame:
    """Sum of squared steps between neighbours over the sum of squares.

    ``order`` must be a unique number. Rows are cut into equal-depth ranges of
    it; steps inside a range use a window per range, and the steps across
    ranges come from the first and last row of each.
    """
    if buckets is None:
        buckets = max(1, min(df.count() // RANGE_ROWS + 1, MAX_RANGES))
    rows = with_range_bucket(df.select(F.col(order).alias("_o"), F.col(residual).alias("_e")).dropna(), "_o", buckets)
    previous = F.lag("_e").over(Window.partitionBy("bucket").orderBy("_o"))
    inside = rows.withColumn("_step", F.col("_e") - previous)
    per_bucket = inside.groupBy("bucket").agg(
        F.sum(F.col("_step") * F.col("_step")).alias("steps"),
        F.sum(F.col("_e") * F.col("_e")).alias("squares"),
        F.min_by("_e", "_o").alias("first"),
        F.max_by("_e", "_o").alias("last"),
    )
    edge = F.col("first") - F.lag("last").over(Window.orderBy("bucket"))
    total = per_bucket.withColumn("_edge", edge).agg(
        (F.coalesce(F.sum("steps"), F.lit(0.0)) + F.coalesce(F.sum(F.col("_edge") * F.col("_edge")), F.lit(0.0))).alias("num"),
        F.sum("squares").alias("den"),
    )
    return total.select((F.col("num") / F.nullif("den", F.lit(0.0))).alias("durbin_watson"))


def residual_shape(df: DataFrame, residual: str, order: str, g: Gram | None = None) -> DataFrame:
    """Durbin-Watson, Jarque-Bera, omnibus, skew, kurtosis and, given the Gram
    of the fit, the condition number of the design."""
    moments = df.agg(
        F.count(residual).alias("n"), F.skewness(residual).alias("skew"), (F.kurtosis(residual) + 3.0).alias("kurt")
    ).first()
    n, skew, kurt = moments["n"], moments["skew"], moments["kurt"]
    jb = n / 6.0 * (skew**2 + (kurt - 3.0) ** 2 / 4.0)
    k2, k2_p = _chebyshev_normal(n, skew, kurt)
    cond = None
    if g is not None:
        values = np.linalg.eigvalsh(g.raw[:-1, :-1])
        cond = float(math.sqrt(values[-1] / values[0])) if values[0] > 0 else math.inf
    shape = df.sparkSession.createDataFrame(
        [(n, skew, kurt, jb, probability.chi2_upper(jb, 2), k2, k2_p, cond)],
        "n bigint, skew double, kurtosis double, jarque_bera double, jb_p double, omnibus double, omnibus_p double, cond double",
    )
    return shape.withColumn("durbin_watson", durbin_watson(df, residual, order, max(1, min(n // RANGE_ROWS + 1, MAX_RANGES))).scalar())


def shrunken_coefficients(
    g: Gram, alpha: float, l1_ratio: float = 1.0, start: np.ndarray | None = None, tol: float = 1e-9, max_iter: int = 20_000
) -> np.ndarray:
    """Minimise ``SSE/(2n) + alpha*(l1_ratio*|w|_1 + (1-l1_ratio)/2*|w|^2)`` by
    coordinate descent on the centred Gram."""
    a = g.scatter[:-1, :-1] / g.n
    b = g.scatter[:-1, -1] / g.n
    w = np.zeros(g.p) if start is None else start.copy()
    slope = b - a @ w
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    diag = np.diag(a)
    for _ in range(max_iter):
        moved = 0.0
        for j in range(g.p):
            if diag[j] <= 0.0:
                continue
            push = slope[j] + diag[j] * w[j]
            new = math.copysign(max(abs(push) - l1, 0.0), push) / (diag[j] + l2)
            step = new - w[j]
            if step:
                slope -= a[:, j] * step
                w[j] = new
                moved = max(moved, abs(step) * math.sqrt(diag[j]))
        if moved <= tol * max(math.sqrt(g.sst / g.n), 1e-300):
            break
    return w


@dataclass
class PathStep:
    alpha: float
    l1_ratio: float
    intercept: float
    coef: np.ndarray
    train: Gram
    valid: Gram | None

    def kept(self, zero: float = 0.0) -> list[int]:
        return [j for j, v in enumerate(self.coef) if abs(v) > zero]


def shrinkage_path(
    df: DataFrame,
    y: str,
    xs: Sequence[str],
    alphas: Sequence[float],
    l1_ratios: Sequence[float] = (1.0,),
    split: str | None = None,
    train: str = "train",
) -> list[PathStep]:
    """One penalised fit per (alpha, l1_ratio). The table is read once for all
    of them: fitting and both ASEs only need the per-split Grams."""
    found = grams(df, xs, y, split)
    fit_on = found[train if split else "all"]
    rest = [g for s, g in found.items() if s != (train if split else "all")]
    valid = None
    for g in rest:
        valid = g if valid is None else valid + g
    steps = []
    for ratio in l1_ratios:
        w = None
        solved = {}
        for alpha in sorted(alphas, reverse=True):
            w = shrunken_coefficients(fit_on, alpha, ratio, w)
            solved[alpha] = w.copy()
        for alpha in alphas:
            w = solved[alpha]
            steps.append(PathStep(alpha, ratio, float(fit_on.means[-1] - fit_on.means[:-1] @ w), w, fit_on, valid))
    return steps


def lasso_path(df: DataFrame, y: str, xs: Sequence[str], alphas: Sequence[float], split: str | None = None, train: str = "train"):
    return shrinkage_path(df, y, xs, alphas, (1.0,), split, train)


def path_metrics(spark: SparkSession, steps: Sequence[PathStep], zero: float = 0.0, refit: bool = True) -> DataFrame:
    """Per step: columns kept, ASE of the shrunken fit, and of least squares on
    the kept columns, for both splits."""
    rows = []
    for s in steps:
        kept = s.kept(zero)
        line = ols_from_gram(s.train, kept)
        full = np.zeros(s.train.p)
        full[kept] = line.coef
        errors = [s.train.sse(s.intercept, s.coef) / s.train.n, None, None, None, None]
        errors[1] = s.train.sse(line.intercept, full) / s.train.n if refit else None
        if s.valid is not None:
            sse = s.valid.sse(s.intercept, s.coef)
            errors[2] = sse / s.valid.n
            errors[3] = s.valid.sse(line.intercept, full) / s.valid.n if refit else None
            errors[4] = info_criteria(gaussian_ll(sse, s.valid.n), s.valid.n, len(kept))["bic"]
        rows.append((float(s.alpha), float(s.l1_ratio), len(kept), [s.train.xs[j] for j in kept], *errors))
    return spark.createDataFrame(
        rows,
        "alpha double, l1_ratio double, n_kept int, kept array<string>, train_ase double, train_refit_ase double, "
        "valid_ase double, valid_refit_ase double, valid_bic double",
    )


def path_coefficients(spark: SparkSession, steps: Sequence[PathStep]) -> DataFrame:
    """Coefficient of every column at every step."""
    rows = [
        (float(s.alpha), float(s.l1_ratio), name, float(v)) for s in steps for name, v in zip(s.train.xs, s.coef)
    ]
    return spark.createDataFrame(rows, "alpha double, l1_ratio double, term string, coef double")


def best_alpha(metrics: DataFrame, by: str = "valid_ase", last: bool = False) -> DataFrame:
    """The step with the smallest measure; on ties the first alpha, or the last."""
    tie = F.desc("alpha") if last else F.asc("alpha")
    return metrics.orderBy(F.asc(by), tie).limit(1)
