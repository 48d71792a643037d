"""News-article transforms: site keys, keyword counts, rates, feed merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.functions import html, urls, words
from loomstat.operators.reshape import dedup, map_values, union_all
from loomstat.sources.tables import spread_rows


def agency_from_url(
    df: DataFrame,
    url: str = "url",
    out: str = "agency",
    mapping: Mapping[str, str] | None = None,
    known: Sequence[str] | None = None,
    prefixes: Sequence[str] | None = None,
    default: str = "other",
) -> DataFrame:
    """Agency of an article from its URL: site key, recode, then ``default``
    for keys outside the known list."""
    keyed = df.withColumn(out, urls.site_key(F.col(url), list(prefixes) if prefixes else None))
    recoded = map_values(keyed, out, mapping or urls.AGENCY_OF_SITE, keep_unmapped=True)
    return keep_known(recoded, out, known or urls.KNOWN_AGENCIES, default)


def agency_from_domain(
    df: DataFrame, url: str = "url", out: str = "agency", mapping: Mapping[str, str] | None = None
) -> DataFrame:
    """Agency from the registered domain; unmapped domains are null."""
    keyed = df.withColumn(out, urls.registered_domain(F.col(url)))
    return map_values(keyed, out, mapping or urls.AGENCY_OF_DOMAIN)


def keep_known(df: DataFrame, column: str, known: Sequence[str], default: str = "other") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column).isin(list(known)), F.col(column)).otherwise(F.lit(default)))


def count_terms(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """One count column per keyword; matches inside longer words count."""
    return df.select("*", *[words.occurrences(F.col(text), t).alias(t) for t in terms])


def rates_per_thousand(df: DataFrame, counts: Sequence[str], length: str, suffix: str = "_1k") -> DataFrame:
    """Counts per 1000 units of ``length`` (characters if that is what it holds)."""
    return df.select("*", *[words.per_thousand(F.col(c), F.col(length)).alias(f"{c}{suffix}") for c in counts])


def articles_from_pages(pages: DataFrame, url: str = "url", markup: str = "html", keep: Sequence[str] = (), **agency) -> DataFrame:
    """Page rows (url, html) to article rows (agency, url, text, length)."""
    rows = spread_rows(pages.select(*keep, url, markup), url)
    plain = rows.select(*keep, F.col(url).alias("url"), html.page_text(F.col(markup)).alias("text"))
    return agency_from_url(plain.withColumn("length", F.length("text").cast("bigint")), **agency).select(
        *keep, "agency", "url", "text", "length"
    )


def merge_sources(
    url_feed: DataFrame,
    named_feed: DataFrame,
    names: tuple[str, str] = ("api", "crawler"),
    min_length: int = 300,
    feed_names: Mapping[str, str] | None = None,
    order: Sequence[str] = ("source", "article_id"),
    **agency,
) -> DataFrame:
    """Two article feeds as one table, one row per URL.

    The first feed has (article_id, url, text) and gets its agency from the
    URL; the second also has an agency name, which is recoded. Short
    articles are dropped before the merge, so they never reach the shuffle.
    """
    first = agency_from_url(url_feed, **agency).withColumn("source", F.lit(names[0]))
    second = map_values(named_feed, "agency", feed_names or urls.AGENCY_OF_FEED_NAME, keep_unmapped=True)
    second = keep_known(second, "agency", agency.get("known") or urls.KNOWN_AGENCIES).withColumn("source", F.lit(names[1]))
    columns = ["article_id", "agency", "url", "text", "source"]
    both = union_all(first.select(*columns), second.select(*columns))
    sized = both.withColumn("length", F.length("text").cast("bigint")).filter(F.col("length") > min_length)
    return dedup(sized, ["url"], list(order))
