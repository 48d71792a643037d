"""Looking at a table: size, levels, ranges, counts, simple selections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns, and cells in all."""
    width = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(width).cast("bigint").alias("n_columns"),
        (F.col("n_rows") * F.lit(width)).alias("n_cells"),
    )


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def head(df: DataFrame, by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the order of ``by`` (tables have no order of their own)."""
    return df.orderBy(*by).limit(n)


def levels(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def range_of(df: DataFrame, *columns: str) -> DataFrame:
    """One row with ``<c>_min`` and ``<c>_max`` per column, in one pass."""
    return df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def count_where(df: DataFrame, **predicates: Column) -> DataFrame:
    """One row: for each named predicate, how many rows satisfy it."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def text_length_audit(df: DataFrame, text: str, cap: int) -> DataFrame:
    """Cap, longest text, number of texts at or over the cap, rows."""
    size = F.length(F.coalesce(F.col(text), F.lit("")))
    return df.agg(
        F.lit(cap).cast("bigint").alias("cap"),
        F.max(size).cast("bigint").alias("max_length"),
        F.count_if(size >= cap).alias("n_at_cap"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def project(
    df: DataFrame,
    keep: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    literals: Mapping[str, object] | None = None,
) -> DataFrame:
    """Keep, drop, rename and add constant columns as one projection."""
    names = [c for c in (keep if keep is not None else df.columns) if c not in set(drop)]
    rename = rename or {}
    columns = [F.col(c).alias(rename.get(c, c)) for c in names]
    columns += [F.lit(v).alias(c) for c, v in (literals or {}).items()]
    return df.select(*columns)


def filter_min_length(df: DataFrame, text: str, longer_than: int = 300) -> DataFrame:
    return df.filter(F.length(text) > longer_than)


def filter_group(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def _ordering(columns: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc(c) if descending else F.asc(c) for c in columns]


def sort_by(df: DataFrame, column: str, key: Sequence[str], descending: bool = True) -> DataFrame:
    return df.orderBy(*_ordering([column], descending), *[F.asc(k) for k in key])


def top_n(df: DataFrame, column: str, key: Sequence[str], n: int) -> DataFrame:
    """Largest ``n`` rows; each task keeps only its own top n."""
    return sort_by(df, column, key).limit(n)


def bottom_n(df: DataFrame, column: str, key: Sequence[str], n: int) -> DataFrame:
    return sort_by(df, column, key, descending=False).limit(n)


def split_top(df: DataFrame, column: str, key: Sequence[str], n: int, out: str = "in_top") -> DataFrame:
    """Every row, flagged whether it belongs to the largest ``n``.

    ``key`` must be unique. The n-th row (of a short report list) is looked up
    first and the rest compared against it, so the table is never ranked.
    """
    last = top_n(df.select(column, *key), column, key, n).collect()
    if not last:
        return df.withColumn(out, F.lit(False))
    edge = last[-1]
    tie = F.struct(*[F.col(k) for k in key]) <= F.struct(*[F.lit(edge[k]).alias(k) for k in key])
    inside = (F.col(column) > F.lit(edge[column])) | ((F.col(column) == F.lit(edge[column])) & tie)
    return df.withColumn(out, F.coalesce(inside, F.lit(False)))


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)
