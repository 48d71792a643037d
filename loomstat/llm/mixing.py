"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomstat.llm.common import WORD, col, unused
from loomstat.operators.joins import lookup_join
from loomstat.session import cut_lineage


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A join key that sorts by code point with null last and never is null."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def ranked(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number rows of distinct keys 0, 1, ... in key order: ranks inside sorted ranges plus the ranges' counts."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut_lineage(df.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id()))
    counts = parts.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range, so the unpartitioned window sorts no more than that.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return parts.withColumn("_in", inside).join(F.broadcast(offsets), "_range").withColumn(out, F.col("_in") + F.col("_before")).drop("_range", "_in", "_before")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Targets of sources: from (key, source_size) to (key, source_size, target).

    Sources in key order take the weights in turn and split ``share`` times all
    words; a target above ``most`` times its source is cut to that and the rest
    is dealt again by weight until no target is above. Each round is one
    aggregate over the sources; only its three sums come to the driver.
    """
    turn = F.array(*[F.lit(float(w)) for w in weights])
    order = ranked(sizes, "key", "turn").withColumn("weight", F.element_at(turn, (F.col("turn") % len(weights) + 1).cast("int")))
    table = cut_lineage(order.select("key", "source_size", "weight"))
    limit = F.col("source_size") * F.lit(float(most))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = limit <= F.lit(level) * F.col("weight") if full >= 0 else F.lit(False)
        row = table.agg(
            F.sum(F.when(above, limit).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.sum(F.when(above, 1).otherwise(0))
        ).first()
        if row[2] is None or row[2] == full or not row[1]:
            break
        full = row[2]
        level = (share * total - row[0]) / row[1]
    target = F.least(limit, F.lit(level) * F.col("weight"))
    return table.select("key", "source_size", F.when(limit <= F.lit(level) * F.col("weight"), limit).otherwise(target).alias("target"))


def chance(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed only (52 bits of an MD5)."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def mix_plan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix",
) -> DataFrame:
    """The documents with how often the mix takes each.

    Adds ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken``
    (size times copies); columns of these names are replaced. The repetition
    rate of a source is target over size; a document is taken floor(rate) times
    and once more with probability equal to the fraction, drawn from its id.

    Null texts have size 0; null sources are one source, last in order; equal
    ids draw alike, so repeated rows are treated alike; a source without words
    has target 0 and copies 0; an empty table stays empty.
    """
    own = ["size", "source_size", "target", "copies", "taken"]
    kept = [c for c in docs.columns if c.lower() not in own]
    key, rate = unused(docs, "mix_key", "mix_rate")
    sized = docs.select(*[col(c) for c in kept], word_count(col(text)).alias("size"), source_key(col(source)).alias(key))
    sums = sized.groupBy(F.col(key).alias("key")).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights, share, most)
    joined = lookup_join(sized, targets, key)
    rates = joined.withColumn(rate, F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    copies = F.floor(rate) + F.when(chance(col(doc_id), seed) < F.col(rate) - F.floor(rate), 1).otherwise(0)
    return rates.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("size") * F.col("copies")).select(*[col(c) for c in kept], *own)


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as ``mix_plan`` says, with the columns of ``docs``.

    A document without words goes along once if its source has words at all:
    its copies count like those of any other.
    """
    (n,) = unused(docs, "mix_n")
    names = unused(docs, *[f"mix_{i}" for i in range(len(docs.columns))])
    safe = docs.select(*[col(c).alias(n) for c, n in zip(docs.columns, names)])
    place = dict(zip(docs.columns, names))
    for part in ("doc_id", "text", "source"):
        options[part] = place[options.get(part, part)]
    plan = mix_plan(safe, **options)
    repeated = plan.where("copies > 0").withColumn(n, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[col(s).alias(c) for c, s in place.items()])
