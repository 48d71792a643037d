"""Stacking, deduplication, recoding, frequency and pivot tables.

Grouped results are always aggregated before anything is shuffled or
windowed, so one group holding most rows costs no more than the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.operators.joins import BROADCAST_ROWS, lookup_join, reject_repeated_keys


def union_all(*tables: DataFrame) -> DataFrame:
    """Stack by column name; columns a table lacks are null."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


# Order columns of these types fit a long, which is packed with a hash of the row into one decimal.
LONG_ORDERS = {"date": F.unix_date, "timestamp": F.unix_micros} | dict.fromkeys(("byte", "short", "integer", "long"), lambda c: c)
HASH_BITS = 62


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that comes first by ``order`` (a missing value comes first).

    Written as an aggregate rather than a ranking window: each task first
    reduces its own copies to one, so even a key with a third of all rows
    sends one row per task through the shuffle. ``order`` should be unique.

    With one order column that fits a long, a hash aggregate names the winner of
    each 256-bit digest of the key by its order and, for ties, 62 bits of the
    row's hash. The rows then meet the winners on all of these together, so the
    copies of a hot key spread by their order instead of meeting in one task, and
    wide rows are never sorted to be compared. Rows alike in every column leave
    one. The columns must be ones that Spark can group by.
    """
    rest = [c for c in df.columns if c not in set(key)]
    if not rest:
        return df.distinct()
    kind = df.schema[order[0]].dataType.typeName()
    if len(order) == 1 and kind in LONG_ORDERS:
        parts = [F.coalesce(F.concat(F.lit("v"), F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("n")) for c in key]
        tie = F.shiftrightunsigned(F.xxhash64(*df.columns), 64 - HASH_BITS).cast("decimal(19,0)")
        place = LONG_ORDERS[kind](F.col(order[0])).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
        step = F.lit(str(1 << HASH_BITS)).cast("decimal(19,0)")
        named = F.coalesce(place * step + tie, tie - step).cast("decimal(38,0)")
        marked = df.withColumn("_digest", F.unhex(F.sha2(F.concat(*parts), 256))).withColumn("_name", named)
        first = marked.groupBy("_digest").agg(F.min("_name").alias("_name"))
        won = marked.join(first, ["_digest", "_name"], "left_semi")
        return won.groupBy("_digest", "_name", *df.columns).agg(F.lit(1)).select(*df.columns)
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    out = df.groupBy(*key).agg(first).select(*key, "_row.*")
    return out.select(*df.columns)


def merge_report(inputs: Mapping[str, DataFrame], merged: DataFrame) -> DataFrame:
    """Rows of every input and of the result, and how many rows the merge dropped."""
    counts = [
        t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, t in inputs.items()
    ]
    kept = merged.agg(F.count(F.lit(1)).alias("n")).select(F.lit("merged").alias("table"), "n")
    read = union_all(*counts)
    dropped = union_all(
        read.select(F.col("n").alias("d")), kept.select((-F.col("n")).alias("d"))
    ).agg(F.sum("d").alias("n")).select(F.lit("dropped").alias("table"), "n")
    return union_all(read, kept, dropped)


def mapping_table(spark, mapping: Mapping, key: str = "_from", value: str = "_to") -> DataFrame:
    rows = sorted(mapping.items(), key=lambda kv: str(kv[0]))
    kind = {bool: "boolean", int: "bigint", float: "double"}
    types = [kind.get(type(rows[0][i]), "string") for i in (0, 1)] if rows else ["string", "string"]
    return spark.createDataFrame(rows, f"`{key}` {types[0]}, `{value}` {types[1]}")


def map_values(
    df: DataFrame,
    column: str,
    mapping: Mapping | DataFrame,
    out: str | None = None,
    default=None,
    keep_unmapped: bool = False,
) -> DataFrame:
    """Recode a column by a dictionary. Unmapped values become ``default``,
    or stay as they are with ``keep_unmapped``.

    A literal dictionary has a known size; a two-column table is measured.
    """
    out = out or column
    literal = not isinstance(mapping, DataFrame)
    table = mapping_table(df.sparkSession, mapping) if literal else mapping.toDF("_from", "_to")
    if not literal:
        reject_repeated_keys(table, "_from")
    joined = lookup_join(df, table, column, bounded=literal and len(mapping) <= BROADCAST_ROWS)
    value: Column = F.col("_to")
    if keep_unmapped:
        value = F.coalesce(value, F.col(column))
    elif default is not None:
        value = F.coalesce(value, F.lit(default))
    return joined.withColumn(out, value).drop("_to")


def attach_scores(df: DataFrame, scores: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add per-row results to their base table by key; unscored rows stay."""
    return df.join(scores, list(key), "left")


def group_mean(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def mean_and_count(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Group means with group size and share: one aggregate where a join of two would do."""
    grouped = df.groupBy(*key).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], F.count(F.lit(1)).alias("n")
    )
    total = grouped.agg(F.sum("n")).scalar()
    return grouped.withColumn("pct", 100.0 * F.col("n") / total)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def freq_table(df: DataFrame, column: str, total_label: str = "TOTAL") -> DataFrame:
    """Value, n, percent of all rows, and a total row.

    The roll-up runs over the already counted values, not over the rows.
    """
    counted = df.groupBy(F.col(column).cast("string").alias(column)).agg(F.count(F.lit(1)).alias("n"))
    grand = counted.agg(F.sum("n").alias("n"))
    return (
        counted.rollup(column)
        .agg(F.sum("n").alias("n"), F.grouping(column).alias("_g"))
        .select(
            F.when(F.col("_g") == 1, F.lit(total_label)).otherwise(F.col(column)).alias(column),
            "n",
            (100.0 * F.col("n") / grand.scalar()).alias("pct"),
        )
    )


def crosstab(df: DataFrame, a: str, b: str, pct_of: str = "row", total_label: str = "TOTAL") -> DataFrame:
    """Per ``a`` each ``b`` with its count and percent, and a total row per ``a``.

    Percentages are of the ``a`` group (``row``) or of all rows (``table``);
    the total row of an ``a`` always shows its percent of all rows.
    """
    if pct_of not in ("row", "table"):
        raise ValueError("pct_of must be 'row' or 'table'")
    cells = df.groupBy(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)).agg(
        F.count(F.lit(1)).alias("n")
    )
    sums = cells.groupBy(F.col(a).alias("_a")).agg(F.sum("n").alias("_an"))
    everything = cells.agg(F.sum("n")).scalar()
    base = F.col("_an") if pct_of == "row" else everything
    inner = cells.join(sums, F.col(a).eqNullSafe(F.col("_a"))).select(
        a, b, "n", (100.0 * F.col("n") / base).alias("pct")
    )
    totals = sums.select(
        F.col("_a").alias(a),
        F.lit(total_label).alias(b),
        F.col("_an").alias("n"),
        (100.0 * F.col("_an") / everything).alias("pct"),
    )
    return inner.unionByName(totals)


def pivot_mean(df: DataFrame, row: str, column: str, value: str, columns: Sequence) -> DataFrame:
    """Matrix of means; the pivoted values are listed, so no extra pass finds them."""
    return df.groupBy(row).pivot(column, list(columns)).agg(F.avg(value))


def pivot_multi(df: DataFrame, key: str, aggs: Mapping[str, str], order_by: str | None = None) -> DataFrame:
    """Per key one aggregate per column (``{"sentiment": "avg", "n": "sum"}``),
    ordered by one of them, descending."""
    out = df.groupBy(key).agg(*[getattr(F, fn)(c).alias(c) for c, fn in aggs.items()])
    return out.orderBy(F.desc(order_by), F.asc(key)) if order_by else out


def sign_split(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Per group how many rows are positive and negative, with percent of all its rows."""
    counts = df.groupBy(group).agg(
        F.count_if(F.col(measure) > 0).alias("n_pos"),
        F.count_if(F.col(measure) < 0).alias("n_neg"),
        F.count(measure).alias("n"),
    )
    share = lambda c: F.round(100.0 * F.col(c) / F.nullif("n", F.lit(0)), 1)
    return counts.select(group, "n_pos", "n_neg", "n", share("n_pos").alias("pct_pos"), share("n_neg").alias("pct_neg"))


def mentions_long(df: DataFrame, counts: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per (row, mentioned subject): subjects whose count column is positive."""
    pairs = F.array(*[F.struct(F.lit(name).alias("subject"), F.col(c).cast("double").alias("hits")) for name, c in counts.items()])
    return df.select(*keep, F.inline(F.filter(pairs, lambda p: p["hits"] > 0)))


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of y on x in one aggregate."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def fitted_line(df: DataFrame, x: str, y: str, out: str = "y_est") -> DataFrame:
    """Each row with its value on the fitted line; the two numbers come as scalar subqueries."""
    fit = line_fit(df, x, y)
    return df.withColumn(out, fit.select("intercept").scalar() + fit.select("slope").scalar() * F.col(x))
