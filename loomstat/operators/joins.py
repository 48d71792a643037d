"""Joins to a lookup table that hold up when one key owns a third of the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup table is broadcast only after measuring that it has at most this many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# Otherwise a key with more rows than this part of an even partition's share is dealt over salts of its own.
HOT_PART = 0.5
# Distinct keys that the sketch of the big side tracks: a key of a partition's share is far above its error.
TRACKED = 65_536


def fits(table: DataFrame, rows: int, size: int) -> bool:
    """Measure at most ``rows + 1`` rows of the table: eight bytes a value, and what strings and binaries hold."""
    wide = [c.name for c in table.schema.fields if c.dataType.typeName() in ("string", "binary")]
    held = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in wide), F.lit(8 * len(table.columns)))
    seen = table.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(held).alias("bytes")).first()
    return seen["n"] <= rows and (seen["bytes"] or 0) <= size


def fits_broadcast(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the table is measured to be small enough for a broadcast."""
    return fits(table, rows, BROADCAST_BYTES)


def reject_repeated_keys(table: DataFrame, key: str) -> None:
    """A key listed twice would double the rows that have it."""
    twice = table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).first()
    if twice is not None:
        raise ValueError(f"the lookup table lists {twice[0]!r} more than once")


def hot_keys(big: DataFrame, column: str, partitions: int) -> list[tuple[object, int]]:
    """(key, salts) of the keys that hold more than HOT_PART of a partition's even share of the rows.

    A sketch finds them in one pass over the key column that returns at most
    2 * ``partitions`` keys; each gets a salt per share that its rows would fill.
    Missing keys are one of them where they are that many. Binary keys, which
    the sketch does not take, go through it as hexadecimal text.
    """
    top = max(1, min(int(partitions / HOT_PART), TRACKED // 2))
    named = F.col(f"`{column}`")
    binary = big.schema[column].dataType.typeName() == "binary"
    sketched = f"hex(`{column}`)" if binary else f"`{column}`"
    found = big.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(named.isNull()).alias("missing"), F.expr(f"approx_top_k({sketched}, {top}, {TRACKED})").alias("top")
    ).first()
    share = max(found["n"] / partitions, 1.0)
    counted = [(bytearray.fromhex(r["item"]) if binary else r["item"], r["count"]) for r in found["top"] or [] if r["item"] is not None] + [(None, found["missing"])]
    return [(key, math.ceil(n / (HOT_PART * share))) for key, n in counted if n > HOT_PART * share]


def lookup_join(
    big: DataFrame, table: DataFrame, column: str, how: str = "left", bounded: bool = False
) -> DataFrame:
    """Join rows to a table whose first column is a unique key for ``column``.

    ``bounded`` says the caller knows the table is small (a literal list). The
    key column of the table does not appear in the result. Beyond broadcast
    size the rows of each hot key are dealt over as many salts as its measured
    share of the rows asks for, and only the table's rows of hot keys are repeated.
    """
    key = table.columns[0]
    lookup = table.withColumnRenamed(key, "_key")
    if bounded or fits_broadcast(lookup):
        joined = big.join(F.broadcast(lookup), F.col(column) == F.col("_key"), how)
        return joined.drop("_key")
    spark = big.sparkSession
    hot = hot_keys(big, column, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not hot:
        return big.join(lookup, F.col(column) == F.col("_key"), how).drop("_key")
    kind = big.schema[column].dataType
    salts = spark.createDataFrame(hot, T.StructType([T.StructField("_hot", kind), T.StructField("_salts", T.IntegerType())]))
    # Equal rows of different partitions differ in their salt, and a task that runs again gives the same ones.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in big.columns]), F.coalesce("_salts", F.lit(1))).cast("int")
    salted = big.join(F.broadcast(salts), F.col(column).eqNullSafe(F.col("_hot")), "left").withColumn("_salt", salt).drop("_hot", "_salts")
    known = lookup.join(F.broadcast(salts), F.col("_key") == F.col("_hot"), "left")
    spread = known.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_hot", "_salts")
    on = (F.col(column) == F.col("_key")) & (F.col("_salt") == F.col("_slot"))
    return salted.join(spread, on, how).drop("_key", "_salt", "_slot")
