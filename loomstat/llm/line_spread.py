"""Line dedup by distinct-site spread: HyperLogLog sketches per line hash, exact counts near the threshold.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import col, unused
from loomstat.operators.joins import lookup_join
from loomstat.session import cut_lineage

# A line on this many sites or more is boilerplate.
SITES = 5
# log2 of the sketch's registers; its relative standard error is about 1.04 / sqrt(2^12).
LOG_K = 12
ERROR = 1.04 / 2 ** (LOG_K / 2)
# Estimates within this many standard errors of the threshold (and at least one) are counted exactly.
ERRORS = 6
LAST = 2**63 - 1


def line_keys(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """One row per line that is not blank: doc, text_hash (both name the document), pos, key, site."""
    doc = docs.select(
        F.coalesce(col(doc_id).cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(col(text)).alias("text_hash"),
        F.when(col(site).isNull(), "n").otherwise(F.concat(F.lit("s"), col(site).cast("string"))).alias("site"),
        F.posexplode(F.split(col(text), "\n", -1)).alias("pos", "line"),
    )
    return doc.where("trim(line) <> ''").select("doc", "text_hash", "pos", F.unhex(F.md5("line")).alias("key"), "site")


def spread_lines(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """Lines on at least ``sites`` distinct sites: key, first_doc.

    Every task folds its lines to one sketch a key, and sketches merge by
    aggregation, so a line that fills a third of a table costs a row a task.
    Lines well above the threshold by their estimate are done. Only those near
    it meet their exact, distinct sites, hot lines spread over salts.
    """
    sketched = lines.groupBy("key").agg(F.hll_sketch_agg("site", LOG_K).alias("sketch"), F.min("doc").alias("first_doc"))
    margin = max(1.0, ERRORS * ERROR * sites)
    over = F.hll_sketch_estimate("sketch") - sites
    guessed = cut_lineage(sketched.select("key", "first_doc", over.alias("over")).where(F.col("over") >= -margin))
    sure = guessed.where(F.col("over") > margin).select("key", "first_doc")
    near = guessed.where(F.col("over") <= margin).select(F.col("key").alias("near_key"), "first_doc")
    pairs = lookup_join(lines.select("key", "site"), near, "key", "inner").groupBy("key", "site").agg(F.min("first_doc").alias("first_doc"))
    counted = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("first_doc").alias("first_doc")).where(F.col("n") >= sites)
    return cut_lineage(sure.union(counted.select("key", "first_doc")))


def cut_positions(lines: DataFrame, spread: DataFrame) -> DataFrame:
    """Positions of the lines to cut, in order: doc, text_hash, cut. The first line of the first document stays."""
    hits = lookup_join(lines.select("doc", "text_hash", "pos", "key"), spread.select(F.col("key").alias("cut_key"), "first_doc"), "key", "inner")
    by_line = hits.groupBy("doc", "text_hash", "key").agg(F.sort_array(F.collect_set("pos")).alias("at"), F.max("first_doc").alias("first_doc"))
    first: Column = F.col("doc") == F.col("first_doc")
    cut = F.when(first, F.slice("at", 2, F.size("at"))).otherwise(F.col("at"))
    by_doc = by_line.select("doc", "text_hash", cut.alias("cut")).groupBy("doc", "text_hash")
    return by_doc.agg(F.sort_array(F.flatten(F.collect_list("cut"))).alias("cut"))


def without(lines: Column, cut: Column) -> Column:
    """The lines whose positions are not in ``cut``, a sorted array without repeats.

    Gaps between positions become runs of flags, so each line is looked at once.
    """
    before = F.concat(F.array(F.lit(-1)), cut)
    flags = F.flatten(F.zip_with(cut, F.slice(before, 1, F.size(cut)), lambda c, b: F.concat(F.array_repeat(F.lit(True), c - b - 1), F.array(F.lit(False)))))
    marked = F.zip_with(lines, flags, lambda line, keep: F.struct(line.alias("line"), F.coalesce(keep, F.lit(True)).alias("keep")))
    return F.transform(F.filter(marked, lambda m: m["keep"]), lambda m: m["line"])


def cut_spread_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES, count: str | None = None
) -> DataFrame:
    """The documents without lines that stand on ``sites`` or more sites.

    The occurrence in the document of the smallest id stays, so no content
    leaves the corpus. Lines end at line feeds and are compared exactly; blank
    lines are never cut. With ``count`` a column of that name holds the number
    of lines cut.

    Null texts stay null and empty ones empty; a null site is one site; null ids
    come last when the first document is chosen; repeated rows of one id and text
    are one document and keep the same lines; an empty table stays empty.
    """
    lines = line_keys(docs, doc_id, text, site)
    cuts = cut_positions(lines, spread_lines(lines, sites))
    doc, hashed, cut = unused(docs, "spread_doc", "spread_hash", "spread_cut")
    keyed = docs.withColumns({doc: F.coalesce(col(doc_id).cast("long"), F.lit(LAST)), hashed: F.xxhash64(col(text))})
    cuts = cuts.select(F.col("doc").alias("_" + doc), F.col("text_hash").alias("_" + hashed), F.col("cut").alias(cut))
    joined = keyed.join(cuts, (F.col(doc) == F.col("_" + doc)) & (F.col(hashed) == F.col("_" + hashed)), "left")
    left = F.array_join(without(F.split(col(text), "\n", -1), F.col(cut)), "\n")
    kept = [F.when(F.size(cut) > 0, left).otherwise(col(c)).alias(c) if c == text else col(c) for c in docs.columns if c != count]
    more = [F.coalesce(F.size(cut), F.lit(0)).cast("long").alias(count)] if count else []
    return joined.select(*kept, *more)
