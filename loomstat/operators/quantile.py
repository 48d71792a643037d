"""Exact medians and equal-depth ranges without gathering a group anywhere."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
SMALL = 10_000


def exact_medians(df: DataFrame, value: str, split: str) -> dict:
    """Median of ``value`` per level of ``split`` (a column of few levels).

    Each pass counts a histogram of the range that still holds the middle
    ranks and keeps one bin of it, so two or three passes leave a handful of
    values however many rows there are. Bin edges are taken from the data
    (smallest and largest value in the bin), so rounding cannot lose a rank.
    Infinities are counted as outer bins of their own; only the finite range is
    cut. Nulls and NaN are left out.
    """
    known = df.select(F.col(split).alias("s"), F.col(value).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    finite = F.abs("v") < F.lit(math.inf)
    base = known.filter(finite)
    found, todo = {}, {}
    ends = known.groupBy("s").agg(
        F.min(F.when(finite, F.col("v"))).alias("lo"), F.max(F.when(finite, F.col("v"))).alias("hi"), F.count_if(finite).alias("n"),
        F.count_if(F.col("v") == -math.inf).alias("below"), F.count("v").alias("all"),
    )
    for r in ends.collect():
        ranks = [k - r.below for k in ((r["all"] - 1) // 2, r["all"] // 2)]
        if all(0 <= k < r.n for k in ranks):
            todo[r.s] = {"lo": r.lo, "hi": r.hi, "n": r.n, "ranks": tuple(ranks)}
        else:
            # A middle rank outside the finite values; the other one, if finite, is their end.
            low, high = (-math.inf if k < 0 else math.inf if k >= r.n else r.lo if k == 0 else r.hi for k in ranks)
            found[r.s] = low if low == high else (low + high) / 2.0
    while todo:
        for s in [s for s, t in todo.items() if t["lo"] == t["hi"]]:
            found[s] = todo.pop(s)["lo"]
        small = {s: t for s, t in todo.items() if t["n"] <= SMALL}
        if small:
            kept = base.filter(_inside(small)).groupBy("s", "v").agg(F.count("v").alias("n")).collect()
            for s, t in small.items():
                values = sorted((r.v, r.n) for r in kept if r.s == s)
                found[s] = sum(_at_rank(values, k) for k in t["ranks"]) / 2.0
                del todo[s]
        if not todo:
            break
        place = F.coalesce(
            *[
                F.when(
                    F.col("s").eqNullSafe(F.lit(s)),
                    F.least(F.floor((F.col("v") - t["lo"]) / ((t["hi"] - t["lo"]) / BINS)), F.lit(BINS - 1)),
                )
                for s, t in todo.items()
            ]
        )
        bins = (
            base.filter(_inside(todo))
            .groupBy("s", place.alias("b"))
            .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        for s in list(todo):
            rows = sorted((r.b, r.n, r.lo, r.hi) for r in bins if r.s == s)
            first, below = _bin_of(rows, todo[s]["ranks"][0])
            second, _ = _bin_of(rows, todo[s]["ranks"][1])
            if first != second:
                found[s] = (first[3] + second[2]) / 2.0
                del todo[s]
            elif first[1] == todo[s]["n"] and (first[2], first[3]) == (todo[s]["lo"], todo[s]["hi"]):
                raise ValueError("the range of a median did not shrink")
            else:
                ranks = tuple(k - below for k in todo[s]["ranks"])
                todo[s] = {"lo": first[2], "hi": first[3], "n": first[1], "ranks": ranks}
    return found


def column_medians(df: DataFrame, values: Mapping[str, Column]) -> dict[str, float]:
    """Median of every expression of ``values`` by its name, all refined in the same passes over the table.

    A row becomes one (index, value) pair per expression that is not null, and
    the pairs are counted into bins before the shuffle, so what moves grows with
    expressions times bins, never with rows. An expression without a value has
    no entry.
    """
    names = list(values)
    if not names:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("s"), values[c].cast("double").alias("v")) for i, c in enumerate(names)])
    found = exact_medians(df.select(F.inline(pairs)), "v", "s")
    return {names[i]: median for i, median in found.items()}


def _inside(todo: dict):
    test = F.lit(False)
    for s, t in todo.items():
        test = test | (F.col("s").eqNullSafe(F.lit(s)) & F.col("v").between(t["lo"], t["hi"]))
    return test


def _at_rank(values, rank):
    for v, n in values:
        if rank < n:
            return v
        rank -= n
    raise ValueError("rank outside the values")


def _bin_of(rows, rank):
    below = 0
    for row in rows:
        if rank < below + row[1]:
            return row, below
        below += row[1]
    raise ValueError("rank outside the bins")


def with_range_bucket(df: DataFrame, column: str, buckets: int = 256, out: str = "bucket") -> DataFrame:
    """Number each row by the equal-depth range its value falls in.

    Bucket numbers rise with the value, so work that needs a global order can
    run per bucket and be stitched at the edges.
    """
    if buckets < 2:
        return df.withColumn(out, F.lit(0))
    cuts = df.agg(
        F.percentile_approx(F.col(column).cast("double"), [i / buckets for i in range(1, buckets)], 10 * buckets)
    ).first()[0]
    inner = sorted(set(cuts or []))
    if not inner:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *inner, float("inf")]
    name = f"_{column}_d"
    placed = Bucketizer(splits=splits, inputCol=name, outputCol=out).transform(
        df.withColumn(name, F.col(column).cast("double"))
    )
    return placed.withColumn(out, F.col(out).cast("int")).drop(name)
