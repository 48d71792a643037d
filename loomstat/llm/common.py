"""Names, row identity and connected components shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.session import cut_lineage

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

# A key with more than one in so many rows is joined apart from the others.
HOT_SHARE = 1000


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of the table (case ignored)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(doc_id: Column, modulus: int, remainder: int = 2) -> Column:
    """True for documents whose crc32(doc_id as text) leaves the remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == remainder


def attach_by_key(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of rows to a table with one row per key, where a key may hold any share of the rows.

    A key of more than one in HOT_SHARE rows is joined by broadcast; there are
    fewer than HOT_SHARE such keys, whatever the size. The others meet in a
    shuffle, and rows with a null key in neither. Both inputs should be stored,
    since each is read twice.
    """
    total = rows.count()
    hot = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") * HOT_SHARE > total).select(key)
    hot_rows = table.join(F.broadcast(hot), key, "left_semi")
    often = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_rows), key, "left")
    seldom = rows.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti").join(table, key, "left")
    return often.unionByName(seldom).unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph of long ids.

    ``edges`` has columns ``a`` and ``b``; loops, repeats and nulls are
    harmless. Returns (node, root) for every node that has an edge to another
    node, root being the smallest node reachable. Alternates large-star and
    small-star steps, each an aggregate and a join, until the edges are stars;
    the edges of every round are stored in the shared folder.
    """

    def distinct_pairs(df: DataFrame) -> DataFrame:
        ordered = df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return ordered.where("a is not null and b is not null and a <> b").distinct()

    def signature(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = cut_lineage(distinct_pairs(edges))
    seen = signature(now)
    while seen[0]:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("v"))
        least = least.select("u", F.least("u", "v").alias("m"))
        large = distinct_pairs(both.where("b > a").join(least, both["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, large["a"] == low["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut_lineage(distinct_pairs(small.union(low.select("u", "m"))))
        before, seen = seen, signature(now)
        if before == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
