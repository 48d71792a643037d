"""Token, term and sentiment queries over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import sentiment, terms
from loomstat.plans.catalog import (
    LEMMAS, LEXICON, STOP_WORDS, SYNONYMS, WORDS_SQL, list_sql, query, rounded, table, values_sql,
)
from loomstat.plans.report_queries import SCORED_SQL

TOKENS_SQL = (
    "SELECT doc_id, pos - 1 AS pos, term FROM (SELECT doc_id, "
    r"unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term, "
    r"generate_subscripts(regexp_extract_all(lower(text), '\p{L}+'), 1) AS pos FROM documents)"
)
COUNTS_SQL = f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {WORDS_SQL} AS term FROM documents) GROUP BY 1, 2"


def _docs(spark, d):
    return table(spark, d, "documents")


def _counts(spark, d, **analysis):
    return terms.doc_term(terms.tokenize(_docs(spark, d), "doc_id", together=True, **analysis), "doc_id")


@query(f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, term FROM ({TOKENS_SQL})")
def t1_tokenize(spark, d):
    return terms.tokenize(_docs(spark, d), "doc_id")


@query(
    f"""WITH t AS ({TOKENS_SQL}),
        p AS (SELECT doc_id, pos, term, lead(term) OVER w AS nxt, lag(term) OVER w AS prv FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
        k AS (SELECT doc_id, CASE WHEN term = 'of' AND nxt = 'the' THEN 'ofthe' WHEN term IN ('le', 'les') THEN 'la' WHEN term = 'die' THEN 'der' ELSE term END AS term
              FROM p WHERE NOT (term = 'the' AND coalesce(prv, '') = 'of'))
        SELECT doc_id, term, count(*) AS tf FROM k GROUP BY 1, 2"""
)
def t2_apply_synonyms(spark, d):
    """One-word and two-word synonyms, applied inside the row."""
    return _counts(spark, d, synonyms=SYNONYMS)


@query(
    f"""SELECT doc_id, term, tf FROM ({COUNTS_SQL}) WHERE term NOT IN {list_sql(STOP_WORDS)}"""
)
def t3_remove_stop_words(spark, d):
    return _counts(spark, d, stop_words=STOP_WORDS)


@query(
    f"""SELECT c.doc_id, c.term, c.tf FROM ({COUNTS_SQL}) c
        WHERE term NOT IN (SELECT DISTINCT lower(lang) FROM documents) AND term NOT IN {list_sql(STOP_WORDS)}"""
)
def t3_stop_words_from_data(spark, d):
    """The list extended by the data's own group names, as an anti-join."""
    docs = _docs(spark, d)
    kept = terms.remove_stop_words(terms.tokenize(docs, "doc_id"), STOP_WORDS)
    return terms.doc_term(terms.remove_stop_words(kept, docs.select("lang")), "doc_id")


@query(
    f"""SELECT doc_id, coalesce(m.lemma, c.term) AS term, CAST(sum(tf) AS BIGINT) AS tf FROM ({COUNTS_SQL}) c
        LEFT JOIN {values_sql(LEMMAS, "m(form, lemma)")} ON c.term = m.form GROUP BY 1, 2"""
)
def t4_lemmatize(spark, d):
    """Form to lemma by a table join."""
    return terms.doc_term(terms.recode_terms(terms.tokenize(_docs(spark, d), "doc_id"), LEMMAS), "doc_id")


@query(
    f"""WITH t AS ({TOKENS_SQL}), b AS (SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM t)
        SELECT term, count(*) AS total FROM (SELECT term FROM t UNION ALL SELECT term || ' ' || nxt FROM b WHERE nxt IS NOT NULL) GROUP BY 1"""
)
def t5_ngrams(spark, d):
    grams = terms.ngrams(_docs(spark, d), "doc_id", n_min=1, n_max=2)
    return grams.groupBy("term").agg(F.count(F.lit(1)).alias("total"))


@query(
    f"""WITH c AS ({COUNTS_SQL}), n AS (SELECT count(*) AS n FROM documents),
        s AS (SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM c GROUP BY 1)
        SELECT c.doc_id, c.term, c.tf, s.total, s.df FROM c JOIN s USING (term), n
        WHERE s.df >= 4 AND s.df <= floor(CAST(0.5 AS DOUBLE) * n)"""
)
def t6_doc_term(spark, d):
    """Terms in at least 4 documents and at most half of them."""
    docs = _docs(spark, d)
    return terms.limit_terms(_counts(spark, d), "doc_id", docs.count(), 4, 0.5).select("doc_id", "term", "tf", "total", "df")


@query(f"SELECT doc_id, term, tf FROM ({COUNTS_SQL}) WHERE term IN {list_sql(LEXICON)}")
def t7_doc_term_vocab(spark, d):
    return terms.doc_term_vocab(terms.tokenize(_docs(spark, d), "doc_id"), LEXICON, "doc_id")


IDF_SQL = "(ln((1.0 + n) / (1.0 + df)) + 1.0)"


@query(
    f"""WITH c AS ({COUNTS_SQL}), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents), s AS (SELECT term, count(*) AS df FROM c GROUP BY 1)
        SELECT c.doc_id, c.term, c.tf, s.df, round(c.tf * {IDF_SQL}, 6) AS tfidf FROM c JOIN s USING (term), n"""
)
def t8_tfidf(spark, d):
    return rounded(terms.tfidf(_counts(spark, d), "doc_id", _docs(spark, d).count()))


TABLE_SQL = f"""WITH c AS ({COUNTS_SQL}), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
    s AS (SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM c GROUP BY 1)
    SELECT term, total, df, round(total * {IDF_SQL}, 4) AS tfidf FROM s, n"""


@query(TABLE_SQL)
def t9_term_table(spark, d):
    return rounded(terms.term_table(_counts(spark, d), _docs(spark, d).count()), 4)


@query(
    f"""WITH t AS ({TABLE_SQL}) SELECT * FROM (SELECT *, 'most' AS side FROM t ORDER BY total DESC, term LIMIT 20)
        UNION ALL SELECT * FROM (SELECT *, 'least' AS side FROM t ORDER BY total, term LIMIT 20)"""
)
def t9_common_terms(spark, d):
    """The most and least common terms: a top-k report."""
    table_ = terms.term_table(_counts(spark, d), _docs(spark, d).count())
    return rounded(terms.common_terms(table_, 20, 20), 4)


@query(
    f"""WITH s AS (SELECT term, CAST(sum(tf) AS BIGINT) AS total FROM ({COUNTS_SQL}) GROUP BY 1),
        k AS (SELECT row_number() OVER (ORDER BY total DESC, term) AS rank, term, total FROM s)
        SELECT rank, term, total, round(ln(rank), 6) AS log_rank, round(ln(total), 6) AS log_total FROM k"""
)
def t10_zipf_table(spark, d):
    totals = terms.term_stats(_counts(spark, d)).persist()
    return rounded(terms.zipf_table(totals))


GROUPED_SQL = f"SELECT source, term, count(*) AS tf FROM (SELECT source, {WORDS_SQL} AS term FROM documents) GROUP BY 1, 2"


def _grouped(spark, d):
    tokens = terms.tokenize(_docs(spark, d), "doc_id", carry=["source"])
    return tokens.groupBy("source", "term").agg(F.count(F.lit(1)).alias("tf"))


@query(f"SELECT term, CAST(sum(tf) AS BIGINT) AS total FROM ({GROUPED_SQL}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200")
def t11_term_cloud(spark, d):
    """The 200 words of a word cloud over all documents."""
    return terms.term_cloud(_grouped(spark, d))


@query(f"SELECT term, tf AS total FROM ({GROUPED_SQL}) WHERE source = 'src1' ORDER BY 2 DESC, 1 LIMIT 200")
def t11_term_cloud_one_group(spark, d):
    return terms.term_cloud(_grouped(spark, d), "source", only="src1")


@query(
    f"""SELECT source, term, tf AS total, CAST(row_number() OVER (PARTITION BY source ORDER BY tf DESC, term) AS INTEGER) AS place
        FROM ({GROUPED_SQL}) QUALIFY place <= 50"""
)
def t11_term_cloud_per_group(spark, d):
    return terms.term_cloud(_grouped(spark, d), "source", max_words=50)


@query(
    f"""SELECT source, count(*) AS n_unique, CAST(sum(tf) AS BIGINT) AS n_total FROM ({GROUPED_SQL})
        WHERE term IN {list_sql(LEXICON)} GROUP BY 1"""
)
def t11_lexicon_cloud_size(spark, d):
    """Unique and total lexicon words per source."""
    tokens = terms.tokenize(_docs(spark, d), "doc_id", carry=["source"]).filter(F.col("term").isin(sorted(LEXICON)))
    return terms.cloud_size(tokens.groupBy("source", "term").agg(F.count(F.lit(1)).alias("tf")), "source")


def _scores(spark, d):
    return sentiment.sentiment_scores(_docs(spark, d), LEXICON, "doc_id", carry=["source"])


@query(f"SELECT doc_id, source, round(sentiment, 6) AS sentiment, n_words FROM ({SCORED_SQL})")
def t12_sentiment_scores(spark, d):
    return rounded(_scores(spark, d))


@query(
    f"""SELECT source, round(avg(sentiment), 6) AS mean_sentiment, round(avg(n_words), 6) AS mean_n_words, count(*) AS n_docs
        FROM ({SCORED_SQL}) GROUP BY 1"""
)
def t12_sentiment_by_source(spark, d):
    """Flagship: scan, tokens, lexicon join, document scores, group means."""
    return rounded(sentiment.sentiment_by_group(_scores(spark, d), "source"))


@query(
    f"""SELECT round(avg(sentiment), 6) AS mean_sentiment, count(*) AS n_docs, CAST(sum(n_words) AS BIGINT) AS n_terms,
        round(sum(n_words) / count(*), 6) AS terms_per_doc, max(length(text)) AS max_length FROM ({SCORED_SQL})"""
)
def t13_corpus_sentiment(spark, d):
    return rounded(sentiment.corpus_sentiment(_docs(spark, d), _scores(spark, d)))


@query(
    f"""WITH s AS (SELECT doc_id, sentiment, n_words FROM ({SCORED_SQL}) WHERE n_words >= 2),
        e AS (SELECT min(sentiment) AS lo, max(sentiment) AS hi FROM s)
        SELECT 'negative' AS side, doc_id, round(sentiment, 6) AS sentiment, n_words FROM s, e WHERE sentiment = lo
        UNION ALL SELECT 'positive', doc_id, round(sentiment, 6), n_words FROM s, e WHERE sentiment = hi"""
)
def t14_sentiment_extremes(spark, d):
    return rounded(sentiment.sentiment_extremes(_scores(spark, d), "doc_id", 2))
