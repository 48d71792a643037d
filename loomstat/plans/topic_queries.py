"""Topic and text-cluster queries over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import terms, topics
from loomstat.plans.catalog import STOP_WORDS, WORDS_SQL, query, rounded, table

K = 5
# Topics are fitted on terms that are neither rare nor everywhere.
LIMITS = {"min_df": 4, "max_df": 0.5}


def _docs(spark, d):
    return table(spark, d, "documents")


def _lda(spark, d, k=K):
    return topics.topics_lda(topics.doc_weights(_docs(spark, d), "doc_id", stop_words=STOP_WORDS, **LIMITS), "doc_id", k)


def _weights(spark, d):
    docs = _docs(spark, d)
    n = docs.count()
    counts = terms.doc_term(terms.tokenize(docs, "doc_id", together=True, stop_words=STOP_WORDS), "doc_id")
    return terms.tfidf(terms.limit_terms(counts, "doc_id", n, **LIMITS), "doc_id", n)


@query()
def t15_topics_lda(spark, d):
    """Topic probabilities of every document as columns."""
    return rounded(topics.prob_columns(_lda(spark, d).docs, K))


@query()
def t15_topics_lda_online(spark, d):
    """Topic probabilities after stochastic updates: ten rounds over three mini-batches of documents."""
    weights = topics.doc_weights(_docs(spark, d), "doc_id", stop_words=STOP_WORDS, **LIMITS)
    return rounded(topics.prob_columns(topics.topics_lda(weights, "doc_id", K, max_iter=10, batches=3).docs, K))


@query()
def t16_topics_svd(spark, d):
    weights = topics.doc_weights(_docs(spark, d), "doc_id", stop_words=STOP_WORDS, **LIMITS)
    return rounded(topics.prob_columns(topics.topics_svd(weights, "doc_id", K).docs, K, prefix="score"), 4)


STEP_SQL = """(SELECT doc_id, sum(v * w) AS u FROM cells JOIN {w} USING (term) GROUP BY doc_id)"""


@query(
    f"""WITH cells AS (SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS v FROM (SELECT doc_id, {WORDS_SQL} AS term FROM documents) GROUP BY ALL),
        w0 AS (SELECT DISTINCT term, CAST(1 AS DOUBLE) AS w FROM cells),
        u1 AS {STEP_SQL.format(w='w0')}, n1 AS (SELECT sqrt(sum(u * u)) AS n FROM u1),
        w1 AS (SELECT term, sum(v * u / n) AS w FROM cells JOIN u1 USING (doc_id), n1 GROUP BY term),
        u2 AS {STEP_SQL.format(w='w1')}, n2 AS (SELECT sqrt(sum(u * u)) AS n FROM u2),
        w2 AS (SELECT term, sum(v * u / n) AS w FROM cells JOIN u2 USING (doc_id), n2 GROUP BY term)
        SELECT doc_id, round(u / n2.n * (SELECT sqrt(sum(w * w)) FROM w2), 4) AS score1 FROM u2, n2"""
)
def t16_svd_power_steps(spark, d):
    """Two steps towards the first direction of the count matrix, from a start of ones."""
    counts = topics.doc_weights(_docs(spark, d), "doc_id", weighted=False)
    found = topics.topics_svd(counts, "doc_id", 1, rounds=2, tol=0.0, start=F.lit(1.0))
    return rounded(topics.prob_columns(found.docs, 1, prefix="score"), 4)


@query()
def t17_topics_nmf(spark, d):
    found = topics.topics_nmf(_weights(spark, d), "doc_id", K)
    return rounded(topics.topic_terms(found), 4)


@query()
def t18_topics_nmf_kl(spark, d):
    found = topics.topics_nmf_kl(_weights(spark, d), "doc_id", K)
    return rounded(topics.topic_terms(found), 4)


# One round of either factorisation into two topics, from starting values that the twins can repeat.
def _round_start():
    return [1.0 + F.col("doc") % 2, 1.0 + F.col("doc") % 3], [1.0 + F.length("term") % 3, 1.0 + F.length("term") % 4]


CELLS_SQL = f"""cells AS (SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS v FROM (SELECT doc_id, {WORDS_SQL} AS term FROM documents) GROUP BY ALL),
    w0 AS (SELECT DISTINCT doc_id, 1::DOUBLE + doc_id % 2 AS a, 1::DOUBLE + doc_id % 3 AS b FROM cells),
    h0 AS (SELECT DISTINCT term, 1::DOUBLE + length(term) % 3 AS a, 1::DOUBLE + length(term) % 4 AS b FROM cells)"""


def _round_sql(kl: bool) -> str:
    """Both penalties are 0.05, as alpha 0.1 and an equal mix give."""

    def part(w):
        return f"v / ({w}.a * h0.a + {w}.b * h0.b + 1e-12)" if kl else "v"

    def divisor(other, own, c):
        if kl:
            return f"{other}.{c}"
        return f"{own}.a * {other}.{'aa' if c == 'a' else 'ab'} + {own}.b * {other}.{'ab' if c == 'a' else 'bb'}"

    def totals(table_):
        return f"SELECT sum(a) AS a, sum(b) AS b, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM {table_}"

    def update(own, key, total, c):
        return f"{own}.{c} * n.{c} / ({divisor(total, own, c)} + 0.05 + 0.05 * {own}.{c} + 1e-12)"

    return f"""WITH {CELLS_SQL}, hs AS ({totals('h0')}),
        nw AS (SELECT doc_id, sum({part('w0')} * h0.a) AS a, sum({part('w0')} * h0.b) AS b FROM cells JOIN w0 USING (doc_id) JOIN h0 USING (term) GROUP BY doc_id),
        w1 AS (SELECT doc_id, {update('w0', 'doc_id', 'hs', 'a')} AS a, {update('w0', 'doc_id', 'hs', 'b')} AS b FROM w0 JOIN nw n USING (doc_id), hs),
        ws AS ({totals('w1')}),
        nh AS (SELECT term, sum({part('w1')} * w1.a) AS a, sum({part('w1')} * w1.b) AS b FROM cells JOIN w1 USING (doc_id) JOIN h0 USING (term) GROUP BY term),
        h1 AS (SELECT term, {update('h0', 'term', 'ws', 'a')} AS a, {update('h0', 'term', 'ws', 'b')} AS b FROM h0 JOIN nh n USING (term), ws)
        SELECT CAST(0 AS INTEGER) AS topic, term, round(a, 6) AS weight FROM h1 UNION ALL SELECT CAST(1 AS INTEGER), term, round(b, 6) FROM h1"""


@query(_round_sql(False))
def t17_nmf_one_round(spark, d):
    """Term weights after one round with squared loss; they depend on the documents' new weights."""
    counts = topics.doc_weights(_docs(spark, d), "doc_id", weighted=False)
    return rounded(topics.topics_nmf(counts, "doc_id", 2, max_iter=1, value="value", start=_round_start()).terms)


@query(_round_sql(True))
def t18_nmf_kl_one_round(spark, d):
    """Term weights after one round with Kullback-Leibler loss."""
    counts = topics.doc_weights(_docs(spark, d), "doc_id", weighted=False)
    return rounded(topics.topics_nmf_kl(counts, "doc_id", 2, max_iter=1, value="value", start=_round_start()).terms)


RULE_TERMS_SQL = f"""SELECT topic, term, sum(share) AS weight FROM (
        SELECT d.topic, w.term, CAST(1 AS DOUBLE) AS share FROM (SELECT doc_id, doc_id % 3 AS topic FROM documents) d
        JOIN (SELECT doc_id, {WORDS_SQL} AS term FROM documents) w USING (doc_id)) GROUP BY ALL"""


@query(
    f"""SELECT CAST(topic AS INTEGER) AS topic, CAST(place AS INTEGER) AS place, term, weight FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS place FROM ({RULE_TERMS_SQL})) WHERE place <= 15"""
)
def t19_topic_terms_rule(spark, d):
    """Heaviest terms of three rule topics: word counts by remainder of the id."""
    counts = topics.doc_weights(_docs(spark, d), "doc_id", weighted=False)
    table_ = counts.groupBy((F.col("doc_id") % 3).cast("int").alias("topic"), "term").agg(F.sum("value").alias("weight"))
    return topics.topic_terms(topics.Topics(table_, table_, 3))


@query()
def t19_topic_terms(spark, d):
    return rounded(topics.topic_terms(_lda(spark, d)), 4)


# A rule distribution per document: shares of three keywords plus one, so that
# the arg-max and its ties can be repeated by the twin.
SHARES = ["the", "de", "der"]


def _share_sql(word: str) -> str:
    return f"(length(lower(text)) - length(replace(lower(text), '{word}', ''))) / {len(word)} + 1"


RULE_SQL = f"""SELECT doc_id, a / (a + b + c) AS p0, b / (a + b + c) AS p1, c / (a + b + c) AS p2 FROM
    (SELECT doc_id, CAST({_share_sql('the')} AS DOUBLE) AS a, CAST({_share_sql('de')} AS DOUBLE) AS b, CAST({_share_sql('der')} AS DOUBLE) AS c FROM documents)"""
ASSIGN_SQL = f"""SELECT doc_id, CASE WHEN p2 >= p1 AND p2 >= p0 THEN 2 WHEN p1 >= p0 THEN 1 ELSE 0 END AS topic,
    greatest(p0, p1, p2) AS prob, p0, p1, p2 FROM ({RULE_SQL})"""


def _rule_weights(spark, d):
    from loomstat.functions.words import occurrences

    counted = _docs(spark, d).select("doc_id", *[(occurrences(F.col("text"), w) + 1).cast("double").alias(w) for w in SHARES])
    total = sum((F.col(w) for w in SHARES[1:]), F.col(SHARES[0]))
    return counted.select("doc_id", F.array(*[F.col(w) / total for w in SHARES]).alias("weights"))


@query(f"SELECT doc_id, CAST(topic AS INTEGER) AS topic, round(prob, 6) AS prob, round(p0, 6) AS prob1, round(p1, 6) AS prob2, round(p2, 6) AS prob3 FROM ({ASSIGN_SQL})")
def t20_topic_assign(spark, d):
    """Arg-max topic, last on ties, with all weights as columns."""
    assigned = topics.topic_assign(_rule_weights(spark, d), "doc_id")
    return rounded(topics.prob_columns(assigned, 3))


@query()
def t20_topic_assign_lda(spark, d):
    return rounded(topics.topic_assign(_lda(spark, d).docs, "doc_id").drop("weights"))


@query(
    f"""WITH a AS ({ASSIGN_SQL}), t AS (SELECT unnest([0, 1, 2, 3]) AS topic)
        SELECT CAST(t.topic AS INTEGER) AS topic, count(a.doc_id) AS n, round(100.0 * count(a.doc_id) / (SELECT count(*) FROM a), 6) AS pct
        FROM t LEFT JOIN a USING (topic) GROUP BY t.topic"""
)
def t21_topic_counts(spark, d):
    """Four topics asked for, so the one without documents shows with zero."""
    return rounded(topics.topic_counts(topics.topic_assign(_rule_weights(spark, d), "doc_id"), 4))


@query(
    f"""WITH a AS (SELECT topic, n_chars, prob FROM ({ASSIGN_SQL}) JOIN documents USING (doc_id))
        SELECT CAST(topic AS INTEGER) AS topic, round(avg(n_chars), 4) AS mean_n_chars, round(avg(prob), 6) AS mean_prob, count(*) AS n,
               round(100.0 * count(*) / (SELECT count(*) FROM a), 6) AS pct FROM a GROUP BY 1"""
)
def t22_topic_profile(spark, d):
    assigned = topics.topic_assign(_rule_weights(spark, d), "doc_id").select("doc_id", "topic", "prob")
    joined = assigned.join(_docs(spark, d).select("doc_id", "n_chars"), "doc_id")
    out = topics.topic_profile(joined, "topic", ["n_chars", "prob"])
    return out.select("topic", F.round("mean_n_chars", 4).alias("mean_n_chars"), F.round("mean_prob", 6).alias("mean_prob"), "n", F.round("pct", 6).alias("pct"))


def _clusters(spark, d):
    return topics.text_clusters_em(_docs(spark, d), "doc_id", k=9, stop_words=STOP_WORDS)


@query()
def t23_text_clusters_em(spark, d):
    """Nine clusters: sizes, shares and mean document length."""
    clusters = _clusters(spark, d)
    lengths = clusters.docs.join(_docs(spark, d).select("doc_id", "n_chars"), "doc_id")
    means = lengths.groupBy("cluster").agg(F.avg("n_chars").alias("mean_n_chars"))
    return rounded(clusters.sizes.join(means, "cluster", "left"), 4)


@query()
def t23_cluster_terms(spark, d):
    return rounded(_clusters(spark, d).terms, 4)


@query()
def t23_cluster_distances(spark, d):
    return rounded(_clusters(spark, d).distances, 4)


