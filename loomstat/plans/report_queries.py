"""Union, dedup, recode, frequency, crosstab, pivot and article-report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import articles, reshape, sentiment
from loomstat.plans.catalog import KEYWORDS, LEXICON, query, rounded, table, values_sql

SEGMENTS = {"BUILDING": "construction", "AUTOMOBILE": "vehicles", "MACHINERY": "industry"}


@query(
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier"""
)
def r1_union_all(spark, d):
    customers = table(spark, d, "customer").selectExpr("c_custkey id", "c_name name", "c_acctbal balance", "c_mktsegment segment")
    suppliers = table(spark, d, "supplier").selectExpr("s_name name", "s_suppkey id", "s_acctbal balance")
    return reshape.union_all(customers, suppliers)


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def r2_dedup_text(spark, d):
    return reshape.dedup(table(spark, d, "documents").select("doc_id", "text"), ["text"], ["doc_id"])


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"""
)
def r2_dedup_first_order(spark, d):
    orders = table(spark, d, "orders")
    return reshape.dedup(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    """WITH a AS (SELECT text FROM documents WHERE lang = 'en'), b AS (SELECT text FROM documents),
            u AS (SELECT * FROM a UNION ALL SELECT * FROM b), m AS (SELECT DISTINCT text FROM u)
       SELECT 'english' AS "table", count(*) AS n FROM a UNION ALL SELECT 'all', count(*) FROM b
       UNION ALL SELECT 'merged', count(*) FROM m
       UNION ALL SELECT 'dropped', (SELECT count(*) FROM u) - (SELECT count(*) FROM m)"""
)
def r3_merge_report(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    english = docs.filter("lang = 'en'")
    merged = reshape.dedup(reshape.union_all(english, docs), ["text"], ["doc_id"])
    return reshape.merge_report({"english": english, "all": docs}, merged)


PREFIXES = ["m", "www", "blog"]
SITES = ["spam-farm.example.org", "cheap-pills.example"]
SITE_MAP = {"spam-farm.example.org": "spam", "cheap-pills.example": "spam"}
SITE_SQL = r"""regexp_replace(regexp_replace(regexp_replace(
    regexp_extract(lower(trim(url)), '^(?:https?://)?([^/?#:\s]+)', 1),
    '^(?:(?:m|www|blog)\.)+', ''), '(?:\.go)?\.com$', ''), '-post$', '')"""
AGENCY_SQL = f"CASE WHEN {SITE_SQL} IN ('spam-farm.example.org', 'cheap-pills.example') THEN 'spam' ELSE 'other' END"


@query(
    f"""WITH a AS (SELECT page_id AS article_id, {AGENCY_SQL} AS agency, url, html AS text, 'api' AS source FROM pages),
        b AS (SELECT page_id AS article_id, CASE WHEN page_id % 2 = 0 THEN 'sports' ELSE 'other' END AS agency, url, html AS text, 'crawler' AS source FROM pages),
        u AS (SELECT *, length(text) AS length FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE length(text) > 300)
        SELECT article_id, agency, url, source, length FROM u
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY source, article_id) = 1"""
)
def r4_merge_sources(spark, d):
    """Two feeds with different keys for the site become one deduplicated table."""
    pages = table(spark, d, "pages")
    by_url = pages.select(F.col("page_id").alias("article_id"), "url", F.col("html").alias("text"))
    by_name = by_url.withColumn("agency", F.when(F.col("article_id") % 2 == 0, "nhl-news").otherwise("daily-bugle"))
    merged = articles.merge_sources(by_url, by_name, prefixes=PREFIXES, mapping=SITE_MAP, known=["spam", "sports"])
    return merged.select("article_id", "agency", "url", "source", "length")


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'AUTOMOBILE' THEN 'vehicles'
              WHEN 'MACHINERY' THEN 'industry' ELSE 'other' END AS segment FROM customer"""
)
def r5_map_values(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return reshape.map_values(customers, "c_mktsegment", SEGMENTS, "segment", default="other").select("c_custkey", "segment")


@query(
    """SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
)
def r5_map_by_table(spark, d):
    """Recode through a two-column table whose size is measured."""
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, d, "nation").select("n_nationkey", "n_name")
    return reshape.map_values(customers, "c_nationkey", nations, "nation").select("c_custkey", "nation")


@query(
    """SELECT c_custkey, c_mktsegment, n AS n_orders, round(spent, 4) AS spent FROM customer
       LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spent FROM orders GROUP BY 1) ON c_custkey = o_custkey"""
)
def r6_attach_scores(spark, d):
    scores = (
        table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spent"))
    )
    return rounded(reshape.attach_scores(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), scores, ["c_custkey"]), 4)


@query(
    """SELECT l_returnflag, round(avg(l_quantity), 6) AS mean_l_quantity, round(avg(l_extendedprice), 6) AS mean_l_extendedprice,
              count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 6) AS pct FROM lineitem GROUP BY 1"""
)
def r7_join_aggregates(spark, d):
    return rounded(reshape.mean_and_count(table(spark, d, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice"]))


@query("SELECT l_returnflag, l_linestatus, round(avg(l_discount), 8) AS mean_l_discount FROM lineitem GROUP BY 1, 2")
def r8_group_mean(spark, d):
    return rounded(reshape.group_mean(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_discount"]), 8)


@query(f"SELECT page_id, url, {AGENCY_SQL} AS agency, {SITE_SQL} AS site FROM pages")
def r9_agency_from_url(spark, d):
    from loomstat.functions.urls import site_key

    pages = table(spark, d, "pages").select("page_id", "url")
    out = articles.agency_from_url(pages, mapping=SITE_MAP, known=["spam"], prefixes=PREFIXES)
    return out.withColumn("site", site_key(F.col("url"), PREFIXES))


@query(
    r"""SELECT page_id, CASE regexp_extract(regexp_extract(lower(trim(url)), '^(?:https?://)?([^/?#:\s]+)', 1),
              '([^.]+)\.(?:(?:co|com|org|net|gov|ac|edu)\.[a-z]{2}|[a-z]+)$', 1) WHEN 'example' THEN 'sample' END AS agency FROM pages"""
)
def r9_agency_from_domain(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return articles.agency_from_domain(pages, mapping={"example": "sample"}).select("page_id", "agency")


def _occurrence_sql(word: str) -> str:
    return f"CAST((length(lower(text)) - length(replace(lower(text), '{word}', ''))) / {len(word)} AS BIGINT)"


COUNT_SQL = ", ".join(f'{_occurrence_sql(w)} AS "{w}"' for w in KEYWORDS)


@query(f"SELECT doc_id, {COUNT_SQL} FROM documents")
def r10_count_terms(spark, d):
    """Keyword counts in the whole text of every document."""
    return articles.count_terms(table(spark, d, "documents").select("doc_id", "text"), "text", KEYWORDS).drop("text")


RATE_SQL = ", ".join(f'round(1000.0 * {_occurrence_sql(w)} / nullif(length(text), 0), 6) AS "{w}_1k"' for w in KEYWORDS)


@query(f"SELECT doc_id, {RATE_SQL} FROM documents")
def r11_rate_per_1k(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.length("text").alias("length"))
    rates = articles.rates_per_thousand(articles.count_terms(docs, "text", KEYWORDS), KEYWORDS, "length")
    return rounded(rates.select("doc_id", *[f"{w}_1k" for w in KEYWORDS]))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, 1")
def r12_value_counts(spark, d):
    return reshape.value_counts(table(spark, d, "part"), "p_brand")


@query(
    """SELECT coalesce(o_orderpriority, 'TOTAL') AS o_orderpriority, n, round(100.0 * n / max(n) OVER (), 6) AS pct
       FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority))"""
)
def r13_freq_table(spark, d):
    return rounded(reshape.freq_table(table(spark, d, "orders"), "o_orderpriority"))


CROSS_SQL = """WITH c AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {t} GROUP BY 1, 2),
    s AS (SELECT a, sum(n) AS an FROM c GROUP BY 1), g AS (SELECT sum(n) AS total FROM c)
    SELECT c.a AS {a}, c.b AS {b}, c.n, round(100.0 * c.n / {base}, 6) AS pct FROM c JOIN s ON c.a = s.a, g
    UNION ALL SELECT s.a, 'TOTAL', CAST(s.an AS BIGINT), round(100.0 * s.an / g.total, 6) FROM s, g"""


@query(CROSS_SQL.format(a="o_orderstatus", b="o_orderpriority", t="orders", base="s.an"))
def r14_crosstab_row(spark, d):
    return rounded(reshape.crosstab(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority"))


@query(CROSS_SQL.format(a="lang", b="source", t="documents", base="g.total"))
def r14_crosstab_table(spark, d):
    return rounded(reshape.crosstab(table(spark, d, "documents"), "lang", "source", "table"))


HOURS = list(range(24))
HOUR_SQL = ", ".join(f'round(avg(value) FILTER (WHERE hour(ts) = {h}), 6) AS "{h}"' for h in HOURS)


@query(f"SELECT event_type, {HOUR_SQL} FROM events GROUP BY 1")
def r15_pivot_mean(spark, d):
    events = table(spark, d, "events").select("event_type", F.hour("ts").alias("hour"), "value")
    return rounded(reshape.pivot_mean(events, "event_type", "hour", "value", HOURS))


SCORED_SQL = f"""SELECT d.doc_id, d.source, d.lang, d.text,
        coalesce(sum(l.score) / nullif(count(l.score), 0), 0) AS sentiment, count(l.score) AS n_words
    FROM documents d LEFT JOIN (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS term FROM documents) w USING (doc_id)
    LEFT JOIN {values_sql(LEXICON, "l(term, score)")} ON w.term = l.term GROUP BY ALL"""


def scored_articles(spark, d):
    """Documents with sentiment and keyword counts, as the reports use them.

    The counts are taken from the text in the same pass and travel as grouping
    keys of the score, so there is one scan, one shuffle and no join.
    """
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    counted = articles.count_terms(docs, "text", KEYWORDS)
    return sentiment.sentiment_scores(counted, LEXICON, "doc_id", carry=["source", "lang", *KEYWORDS])


@query(
    f"""WITH s AS ({SCORED_SQL})
        SELECT source, round(avg(sentiment), 6) AS sentiment, {", ".join(f'CAST(sum({_occurrence_sql(w)}) AS BIGINT) AS "{w}"' for w in KEYWORDS)}
        FROM s GROUP BY 1 ORDER BY 2 DESC, 1"""
)
def r16_pivot_multi(spark, d):
    aggs = {"sentiment": "avg", **{w: "sum" for w in KEYWORDS}}
    return rounded(reshape.pivot_multi(scored_articles(spark, d), "source", aggs, "sentiment"))


SIGN_SQL = """count(*) FILTER (WHERE {m} > 0) AS n_pos, count(*) FILTER (WHERE {m} < 0) AS n_neg, count({m}) AS n,
    round(100.0 * count(*) FILTER (WHERE {m} > 0) / nullif(count({m}), 0), 1) AS pct_pos,
    round(100.0 * count(*) FILTER (WHERE {m} < 0) / nullif(count({m}), 0), 1) AS pct_neg"""


@query(f"SELECT c_mktsegment, {SIGN_SQL.format(m='c_acctbal')} FROM customer GROUP BY 1")
def r17_sign_split(spark, d):
    return reshape.sign_split(table(spark, d, "customer"), "c_mktsegment", "c_acctbal")


@query(
    f"""WITH s AS ({SCORED_SQL}), m AS ({" UNION ALL ".join(f"SELECT '{w}' AS subject, sentiment FROM s WHERE {_occurrence_sql(w)} > 0" for w in KEYWORDS)})
        SELECT subject, {SIGN_SQL.format(m='sentiment')} FROM m GROUP BY 1"""
)
def r17_sign_split_mentions(spark, d):
    """Positive and negative documents per mentioned subject; a document counts for each."""
    long = reshape.mentions_long(scored_articles(spark, d), {w: w for w in KEYWORDS}, ["doc_id", "sentiment"])
    return reshape.sign_split(long, "subject", "sentiment")


@query(
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem"""
)
def r18_line_fit(spark, d):
    return rounded(reshape.line_fit(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice"), 4)


@query(
    """WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders)
       SELECT o_orderkey, o_custkey, round(a + b * o_custkey, 4) AS y_est FROM orders, f"""
)
def r19_fitted_line(spark, d):
    orders = table(spark, d, "orders")
    return rounded(reshape.fitted_line(orders, "o_custkey", "o_totalprice").select("o_orderkey", "o_custkey", "y_est"), 4)


PAGE_TEXT_SQL = r"""trim(regexp_replace(replace(regexp_replace(
    replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', chr(1)),
    '&#?[A-Za-z0-9]+;', ' ', 'g'), chr(1), '&'), '\s+', ' ', 'g'))"""


@query(f"""SELECT page_id, {AGENCY_SQL} AS agency, url, {PAGE_TEXT_SQL} AS text, length({PAGE_TEXT_SQL}) AS length FROM pages""")
def s9_articles_from_pages(spark, d):
    return articles.articles_from_pages(
        table(spark, d, "pages"), keep=["page_id"], mapping=SITE_MAP, known=["spam"], prefixes=PREFIXES
    )
