"""Tokens, n-grams, term counts and weights as long tables.

A document is one row, so everything that only needs one document (joining
phrases, recoding, n-grams, stop words from a literal list) happens on the
word array inside the row. The long table (doc, term, tf) appears only
where terms of different documents meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
import math

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomstat.functions import words
from loomstat.operators.joins import BROADCAST_ROWS, fits, lookup_join, reject_repeated_keys
from loomstat.session import cut_lineage
from loomstat.sources.tables import spread_rows

# Rows of one term that may meet in one task.
TERM_ROWS = 1_000_000
# Statistics of terms that every task may hold: they are three columns, and where they move the counts do not.
STATS_ROWS = 2_000_000
STATS_BYTES = 96 << 20


def with_words(
    df: DataFrame,
    text: str,
    out: str = "words",
    synonyms: Mapping[str, str] | None = None,
    stop_words: Iterable[str] = (),
    lemmas: Mapping[str, str] | None = None,
    n_min: int = 1,
    n_max: int = 1,
) -> DataFrame:
    """Add the analysed word array of each document.

    Order: words, two-word synonyms, one-word synonyms, lemmas, stop words,
    n-grams. For maps too large for a literal use the table forms
    ``recode_terms`` and ``remove_stop_words``.
    """
    clean = {" ".join(k.lower().split()): v for k, v in (synonyms or {}).items()}
    phrases = {k: v for k, v in clean.items() if " " in k}
    array = words.word_array(F.col(text))
    if phrases:
        array = words.join_phrases(array, phrases)
    single = {k.replace(" ", words.PHRASE_MARK): v for k, v in clean.items()}
    array = words.recode_words(array, single)
    array = words.recode_words(array, {k.lower(): v for k, v in (lemmas or {}).items()})
    stop = sorted({w.lower() for w in stop_words})
    if stop:
        array = F.filter(array, lambda w: ~w.isin(stop))
    return df.withColumn(out, words.gram_array(array, n_min, n_max))


def tokenize(df: DataFrame, key: str, text: str = "text", carry: Sequence[str] = (), together: bool = False, **analysis) -> DataFrame:
    """One row per word: (key, pos, term).

    ``together`` deals the texts by key first, so that counts per document
    need no shuffle of their words, which take several times the bytes.
    """
    rows = df.select(key, *carry, text)
    spread = spread_rows(rows, key)
    prepared = with_words(rows.repartition(key) if together and spread is rows else spread, text, "_words", **analysis)
    # The outer form keeps the optimizer from adding a "has words" filter, which
    # would analyse every text a second time below the spread.
    exploded = prepared.select(key, *carry, F.posexplode_outer("_words").alias("pos", "term"))
    return exploded.filter(F.col("term").isNotNull())


def ngrams(df: DataFrame, key: str, text: str = "text", n_min: int = 1, n_max: int = 2, **analysis) -> DataFrame:
    """One row per n-gram occurrence: (key, term)."""
    prepared = with_words(spread_rows(df.select(key, text), key), text, "_words", n_min=n_min, n_max=n_max, **analysis)
    return prepared.select(key, F.explode_outer("_words").alias("term")).filter(F.col("term").isNotNull())


def recode_terms(tokens: DataFrame, mapping: Mapping[str, str] | DataFrame, term: str = "term") -> DataFrame:
    """One-word synonyms or lemmas from a form -> canonical table."""
    literal = not isinstance(mapping, DataFrame)
    if literal:
        rows = sorted((k.lower(), v) for k, v in mapping.items())
        table = tokens.sparkSession.createDataFrame(rows, "_from string, _to string")
    else:
        table = mapping.toDF("_from", "_to")
        reject_repeated_keys(table, "_from")
    joined = lookup_join(tokens, table, term, bounded=literal and len(mapping) <= BROADCAST_ROWS)
    return joined.withColumn(term, F.coalesce("_to", term)).drop("_to")


def remove_stop_words(tokens: DataFrame, stop: Iterable[str] | DataFrame, term: str = "term") -> DataFrame:
    """Drop listed terms. A list becomes a hashed set in the filter; a table
    (for instance the data's own group names) becomes a left-anti join."""
    if isinstance(stop, DataFrame):
        table = stop.select(F.lower(F.col(stop.columns[0])).alias("_stop")).distinct()
        return lookup_join(tokens, table, term, "left_anti")
    listed = sorted({w.lower() for w in stop})
    return tokens.filter(~F.col(term).isin(listed)) if listed else tokens


def doc_term(tokens: DataFrame, key: str, term: str = "term") -> DataFrame:
    """Count of each term in each document. A document's words sit in one
    task, so the map-side aggregate already finishes the count; words that were
    tokenised ``together`` are not shuffled again."""
    return tokens.groupBy(key, F.col(term).alias("term")).agg(F.count(F.lit(1)).alias("tf"))


def df_bound(value: float | int, n_docs: int, upper: bool) -> int:
    """A document-frequency bound: a proportion of the documents if it is a
    float up to 1, else a count."""
    if isinstance(value, float) and value <= 1.0:
        return math.floor(value * n_docs) if upper else math.ceil(value * n_docs)
    return int(value)


def term_stats(counts: DataFrame) -> DataFrame:
    """Per term its total frequency and the number of documents with it."""
    return counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))


def join_term_stats(counts: DataFrame, stats: DataFrame, key: str, n_docs: int) -> DataFrame:
    """Add per-term statistics to the (key, term, tf) table.

    Statistics that are measured to be small go to every task, so the counts
    stay where they are, dealt by document. Beyond that they meet by term.
    A term has a row per document, "the" one in nearly all. Its rows are dealt
    by document over as many salts as keep a (term, salt) pair to about
    ``TERM_ROWS`` rows, and the statistics go to the pairs that exist, so no
    list of frequent terms is needed and no task holds a whole term. Few
    documents need one salt, and counts and statistics then share one shuffle.
    """
    stats = cut_lineage(stats)
    if fits(stats, STATS_ROWS, STATS_BYTES):
        return counts.join(F.broadcast(stats), "term")
    salts = -(-n_docs // TERM_ROWS)
    if salts <= 1:
        return counts.join(stats, "term")
    dealt = counts.withColumn("_s", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    placed = dealt.select("term", "_s").distinct().join(stats, "term")
    return dealt.join(placed, ["term", "_s"]).drop("_s")


def limit_terms(
    counts: DataFrame, key: str, n_docs: int, min_df: float | int = 1, max_df: float | int = 1.0
) -> DataFrame:
    """Keep the terms found in at least ``min_df`` and at most ``max_df``
    documents; adds ``total`` and ``df``."""
    low, high = df_bound(min_df, n_docs, False), df_bound(max_df, n_docs, True)
    stats = term_stats(counts).filter(F.col("df").between(low, high))
    return join_term_stats(counts, stats, key, n_docs)


def doc_term_vocab(tokens: DataFrame, vocabulary: Iterable[str] | DataFrame, key: str) -> DataFrame:
    """Term counts for the words of a given vocabulary only."""
    if isinstance(vocabulary, DataFrame):
        table = vocabulary.select(F.col(vocabulary.columns[0]).alias("term")).distinct()
        return doc_term(lookup_join(tokens, table, "term", "left_semi"), key)
    return doc_term(tokens.filter(F.col("term").isin(sorted(set(vocabulary)))), key)


def idf(df: str, n_docs: int):
    """Smoothed inverse document frequency: ln((1+n)/(1+df)) + 1."""
    return F.log((1.0 + F.lit(n_docs)) / (1.0 + F.col(df))) + 1.0


def tfidf(counts: DataFrame, key: str, n_docs: int) -> DataFrame:
    """Weight of each (document, term): tf times the smoothed idf, not normalised."""
    joined = counts if "df" in counts.columns else join_term_stats(counts, term_stats(counts), key, n_docs)
    return joined.select(key, "term", "tf", "df", (F.col("tf") * idf("df", n_docs)).alias("tfidf"))


def term_table(counts: DataFrame, n_docs: int) -> DataFrame:
    """Per term: total, document frequency and summed TF-IDF.

    The idf is the same for all documents of a term, so the sum is
    total x idf and no join back to the documents is needed."""
    stats = term_stats(counts)
    return stats.withColumn("tfidf", F.col("total") * idf("df", n_docs))


def common_terms(table: DataFrame, top: int, bottom: int) -> DataFrame:
    """The most and the least common terms, marked in ``side``."""
    most = table.orderBy(F.desc("total"), "term").limit(top).withColumn("side", F.lit("most"))
    least = table.orderBy(F.asc("total"), "term").limit(bottom).withColumn("side", F.lit("least"))
    return most.unionByName(least)


def zipf_table(totals: DataFrame) -> DataFrame:
    """Rank, frequency and logarithms for every term.

    The rank is global but never computed in one task: the terms are cut into
    ranges by sampling, ranked inside each, and the sizes of earlier ranges are
    added. Ranges are even however many terms share a total; the window over
    them has one row each.
    """
    totals = totals.select("term", "total")
    ranges = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("total"), F.asc("term")]
    terms = cut_lineage(totals.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = terms.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = F.broadcast(sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    ranked = terms.withColumn("_place", place).join(offsets, "_range")
    rank = F.col("_before") + F.col("_place")
    return ranked.select(
        rank.cast("bigint").alias("rank"),
        "term",
        "total",
        F.log(rank).alias("log_rank"),
        F.log("total").alias("log_total"),
    )


def term_cloud(
    counts: DataFrame, group: str | None = None, max_words: int = 200, only: str | None = None
) -> DataFrame:
    """The most frequent terms, over all documents, for one group (``only``)
    or for every group. ``counts`` carries the group column.

    The per-group cut is a row_number filter, which Spark applies inside each
    task before the shuffle, so a group's whole vocabulary is never sorted in
    one place.
    """
    rows = counts.filter(F.col(group) == only) if only is not None else counts
    if group is None or only is not None:
        return rows.groupBy("term").agg(F.sum("tf").alias("total")).orderBy(F.desc("total"), "term").limit(max_words)
    totals = rows.groupBy(group, "term").agg(F.sum("tf").alias("total"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("total"), "term"))
    return totals.withColumn("place", place).filter(F.col("place") <= max_words)


def cloud_size(counts: DataFrame, group: str | None = None) -> DataFrame:
    """Number of distinct terms and of occurrences, overall or per group."""
    keys = [group] if group else []
    totals = counts.groupBy(*keys, "term").agg(F.sum("tf").alias("total"))
    return totals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_unique"), F.sum("total").alias("n_total"))
