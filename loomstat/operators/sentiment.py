"""Lexicon sentiment of documents and of the corpus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions.words import bind, word_array
from loomstat.operators.joins import BROADCAST_ROWS, lookup_join, reject_repeated_keys
from loomstat.operators.terms import with_words
from loomstat.sources.tables import spread_rows


# A lexicon up to this size is matched inside the row.
ROW_ENTRIES = 1000


def hits_sentiment(words: Column, lexicon: Mapping[str, float]) -> Column:
    """Struct (n_words, sentiment) of an array of words.

    Hits are found by set membership first; only they look up the map.
    """
    entries = sorted((t.lower(), float(s)) for t, s in lexicon.items())
    table = F.create_map(*[F.lit(x) for kv in entries for x in kv])

    def score(hits: Column) -> Column:
        total = F.aggregate(hits, F.lit(0.0), lambda acc, w: acc + F.element_at(table, w))
        mean = F.when(F.size(hits) > 0, total / F.size(hits)).otherwise(F.lit(0.0))
        return F.struct(F.size(hits).cast("bigint").alias("n_words"), mean.alias("sentiment"))

    listed = [t for t, _ in entries]
    return bind(F.filter(F.coalesce(words, F.array().cast("array<string>")), lambda w: w.isin(listed)), score)


def row_sentiment(text: Column, lexicon: Mapping[str, float]) -> Column:
    """The same for a text, so a stream needs no aggregate before the grouping one."""
    return hits_sentiment(word_array(text), lexicon)


def sentiment_scores(
    docs: DataFrame,
    lexicon: Mapping[str, float] | DataFrame,
    key: str,
    text: str = "text",
    carry: Sequence[str] = (),
    n_max: int = 1,
    **analysis,
) -> DataFrame:
    """Per document: number of lexicon words and their mean score (0 if none).

    A short literal lexicon is matched inside the row: no word leaves it and
    nothing is shuffled. With a lexicon table every document stays in the
    stream as at least one row, and ``carry`` columns are grouping keys, so
    zero-hit documents and group labels need no join back to the base table.
    """
    literal = not isinstance(lexicon, DataFrame)
    if literal and 0 < len(lexicon) <= ROW_ENTRIES:
        prepared = with_words(spread_rows(docs.select(key, *carry, text), key), text, "_words", n_max=n_max, **analysis)
        scored = prepared.select(key, *carry, hits_sentiment(F.col("_words"), lexicon).alias("_r"))
        return scored.select(key, *carry, F.col("_r.sentiment").alias("sentiment"), F.col("_r.n_words").alias("n_words"))
    if literal:
        rows = sorted((t.lower(), float(v)) for t, v in lexicon.items())
        table = docs.sparkSession.createDataFrame(rows, "_entry string, score double")
    else:
        table = lexicon.toDF("_entry", "score")
        reject_repeated_keys(table, "_entry")
    prepared = with_words(spread_rows(docs.select(key, *carry, text), key), text, "_words", n_max=n_max, **analysis)
    terms = prepared.select(key, *carry, F.explode_outer("_words").alias("term"))
    found = lookup_join(terms, table, "term", bounded=literal and len(lexicon) <= BROADCAST_ROWS)
    hits, total = F.count("score"), F.sum("score")
    return (
        found.groupBy(key, *carry)
        .agg(hits.alias("n_words"), total.alias("_total"))
        .select(
            key,
            *carry,
            F.coalesce(F.col("_total") / F.nullif(F.col("n_words"), F.lit(0)), F.lit(0.0)).alias("sentiment"),
            "n_words",
        )
    )


def sentiment_by_group(scores: DataFrame, group: str) -> DataFrame:
    return scores.groupBy(group).agg(
        F.avg("sentiment").alias("mean_sentiment"),
        F.avg("n_words").alias("mean_n_words"),
        F.count(F.lit(1)).alias("n_docs"),
    )


def corpus_sentiment(docs: DataFrame, scores: DataFrame, text: str = "text") -> DataFrame:
    """Mean over documents, lexicon hits in all and per document, longest text."""
    longest = docs.agg(F.max(F.length(text))).scalar()
    return scores.agg(
        F.avg("sentiment").alias("mean_sentiment"),
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_words").alias("n_terms"),
        (F.sum("n_words") / F.count(F.lit(1))).alias("terms_per_doc"),
    ).withColumn("max_length", longest.cast("bigint"))


def sentiment_extremes(scores: DataFrame, key: str, n_terms: int = 2) -> DataFrame:
    """Most negative and most positive documents with at least ``n_terms``
    lexicon words, all ties listed. Two aggregates, no global ranking."""
    enough = scores.filter(F.col("n_words") >= n_terms)
    low = enough.agg(F.min("sentiment")).scalar()
    high = enough.agg(F.max("sentiment")).scalar()
    sides = F.array(
        F.when(F.col("sentiment") == low, F.lit("negative")), F.when(F.col("sentiment") == high, F.lit("positive"))
    )
    return enough.select(F.explode(F.array_compact(sides)).alias("side"), key, "sentiment", "n_words")
