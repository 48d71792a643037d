"""Text, cleaning, reshaping and topic operators on small literal tables."""

import math
import random

import numpy as np
from pyspark.sql import functions as F
import pytest

from loomstat.functions import urls, words
from loomstat.operators import articles, clean, joins, profile, reshape, sentiment, terms, topics
from loomstat.operators.clean import Attr
from loomstat.sources import tables


def one(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t"))).first()[0]


def test_words_and_grams(spark):
    assert one(spark, words.word_array, "Été, it's 3 o'clock") == ["été", "it", "s", "o", "clock"]
    assert one(spark, words.word_array, None) == []
    grams = one(spark, lambda t: words.gram_array(words.word_array(t), 1, 3), "a b c d")
    assert grams == ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"]
    assert one(spark, lambda t: words.gram_array(words.word_array(t), 2, 2), "alone") == []


def greedy(tokens, phrases):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in phrases:
            out.append(tokens[i] + words.PHRASE_MARK + tokens[i + 1])
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def test_phrases_are_matched_left_to_right_without_overlap(spark):
    rng = random.Random(3)
    phrases = [("a", "b"), ("b", "a"), ("a", "a"), ("c", "ab")]
    texts = [" ".join(rng.choice(["a", "b", "c", "ab"]) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", words.join_phrases(words.word_array(F.col("t")), [" ".join(p) for p in phrases]).alias("w")).collect()
    for row in rows:
        assert row.w == greedy(texts[row.i].split(), set(phrases)), texts[row.i]


def test_analysis_chain(spark):
    df = spark.createDataFrame([(1, "Cruise control and the brakes; brake fails")], "id int, text string")
    tokens = terms.tokenize(
        df, "id", synonyms={"cruise control": "cruise", "brakes": "brake"}, lemmas={"fails": "fail"}, stop_words=["the", "and"]
    )
    assert [r.term for r in tokens.orderBy("pos").collect()] == ["cruise", "brake", "brake", "fail"]


def test_occurrences_count_inside_words(spark):
    assert one(spark, lambda t: words.occurrences(t, "trump"), "Trump's trumpet. TRUMP") == 3
    assert one(spark, lambda t: words.occurrences(t, "aa"), "aaaa") == 2
    assert one(spark, lambda t: words.occurrences(t, "x"), None) == 0


@pytest.mark.parametrize(
    "url, agency",
    [
        ("https://www.foxnews.com/politics/x", "fox"),
        ("http://abcnews.go.com/US/a", "abc-news"),
        ("https://uk.reuters.com/article", "reuters"),
        ("https://video.foxnews.com/v/1", "fox"),
        ("https://markets.businessinsider.com/x", "business"),
        ("https://www.nhl.com", "sports"),
        ("https://www.pbs.com/x", "pbs"),
        ("https://blog.example.org/", "other"),
        ("HTTPS://AF.Reuters.com:443/x?y#z", "reuters"),
        ("not a url", "other"),
        ("https://www.arstechnica.com/a", "technology"),
    ],
)
def test_agency_from_url(spark, url, agency):
    df = spark.createDataFrame([(url,)], "url string")
    assert articles.agency_from_url(df).first().agency == agency


def test_registered_domain(spark):
    for url, domain in [("https://www.bbc.co.uk/news", "bbc"), ("http://a.b.cnn.com", "cnn"), ("https://x.com.au/", "x"), ("localhost", "")]:
        assert one(spark, urls.registered_domain, url) == domain


def test_page_text(spark):
    from loomstat.functions.html import page_text

    html = "<style>p{}</style><SCRIPT>var a='<p>'</SCRIPT><p>A&amp;lt; &lt;b&gt;&copy;<br>x&#39;s</p><!-- <i>no</i> -->"
    assert one(spark, page_text, html) == "A&lt; <b> x's"


def test_sentiment_means_lexicon_scores(spark):
    docs = spark.createDataFrame([(1, "good good bad"), (2, "nothing here"), (3, None), (4, "bad bad")], "id int, text string")
    scores = {r.id: (round(r.sentiment, 6), r.n_words) for r in sentiment.sentiment_scores(docs, {"good": 2.0, "bad": -3.0}, "id").collect()}
    assert scores == {1: (round(1 / 3, 6), 3), 2: (0.0, 0), 3: (0.0, 0), 4: (-3.0, 2)}
    both = sentiment.sentiment_scores(docs, {"good good": 5.0}, "id", n_max=2).filter("id = 1").first()
    assert (both.sentiment, both.n_words) == (5.0, 1)


def test_printed_sentiment_rows_are_integer_sums():
    for mean, n, total in [(2.0, 7, 14), (1.533333, 15, 23), (-1.222222, 9, -11)]:
        assert round(mean * n, 3) == total


def test_extremes_list_all_ties(spark):
    scores = spark.createDataFrame([(57, -2.75, 4), (160, -2.75, 4), (9, -5.0, 1), (3, 4.0, 2)], "id int, sentiment double, n_words bigint")
    found = sorted((r.side, r.id) for r in sentiment.sentiment_extremes(scores, "id", 2).collect())
    assert found == [("negative", 57), ("negative", 160), ("positive", 3)]


def corpus(spark):
    rng = random.Random(11)
    vocab = ["the"] * 30 + [f"w{i}" for i in range(12)] * 2 + [f"r{i}" for i in range(40)]
    texts = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 40)))) for i in range(120)]
    letters = str.maketrans("0123456789", "abcdefghij")
    return spark.createDataFrame([(i, t.translate(letters)) for i, t in texts], "id int, text string")


@pytest.mark.parametrize("rows", [1, 17, 10**9])
def test_term_limits_with_any_salts(spark, monkeypatch, rows):
    """Dealing the rows of a term over many, few or no salts changes nothing."""
    monkeypatch.setattr(terms, "TERM_ROWS", rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = corpus(spark)
        counts = terms.doc_term(terms.tokenize(docs, "id"), "id")
        got = {(r.id, r.term): (r.tf, r.df) for r in terms.limit_terms(counts, "id", 120, 5, 0.5).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want, df = {}, {}
    for r in docs.collect():
        tokens = r.text.split()
        for t in set(tokens):
            want[r.id, t] = tokens.count(t)
            df[t] = df.get(t, 0) + 1
    assert got == {k: (tf, df[k[1]]) for k, tf in want.items() if 5 <= df[k[1]] <= 60}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_paths_agree(spark, monkeypatch, how):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(90)] + [(99, None)], "i int, k string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), ("zz", 4)], "key string, v int")
    small = sorted(map(str, joins.lookup_join(big, table, "k", how).collect()))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (1,))
    assert sorted(map(str, joins.lookup_join(big, table, "k", how).collect())) == small


def test_zipf_ranks(spark):
    rng = random.Random(2)
    pairs = {f"{rng.choice('abc')}{rng.choice('xyz')}{i:03d}": rng.randint(1, 5) for i in range(200)}
    df = spark.createDataFrame(list(pairs.items()), "term string, total bigint")
    got = {r.term: r.rank for r in terms.zipf_table(df).collect()}
    want = {t: i for i, (t, _) in enumerate(sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0])), 1)}
    assert got == want


def test_stop_words_from_a_table(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "id int, term string")
    stop = spark.createDataFrame([("A",)], "w string")
    assert [r.term for r in terms.remove_stop_words(tokens, stop).collect()] == ["b"]
    assert [r.term for r in terms.remove_stop_words(tokens, ["b"]).collect()] == ["a", "a"]


MAP = {
    "k": Attr("ID"), "x": Attr("Interval", (0.0, 10.0)), "cut": Attr("nominal", ("Fair", "Good", "Ideal")),
    "Year": Attr("nominal", (2001, 2002, 2003)), "y": Attr("binary", ("bad", "good")), "note": Attr("text"),
}


@pytest.fixture(scope="module")
def dirty(spark):
    data = [
        (1, 1.0, "Fair", 2001, "good", "n"), (2, 99.0, "Good", 2003, "bad", "n"), (3, None, "Good", 1999, "good", "n"),
        (4, float("nan"), "Poor", 2003, "bad", None), (5, 7.0, None, None, "ugly", "n"), (6, 4.0, "Ideal", 2003, None, "n"),
    ]
    return spark.createDataFrame(data, "k int, x double, cut string, Year int, y string, note string")


def test_audit(dirty):
    got = {r.attribute: (r.missing, r.outliers) for r in clean.attribute_audit(dirty, MAP).collect()}
    assert got == {"k": (0, 0), "x": (2, 1), "cut": (1, 1), "Year": (1, 1), "y": (1, 1), "note": (1, 0)}


def test_cleaner(dirty):
    cleaner = clean.TableCleaner(MAP, no_impute=["y"], keep=["k"])
    out = {r.k: r.asDict() for r in cleaner.fit_transform(dirty).collect()}
    assert cleaner.features() == ["x", "cut0:Fair", "cut1:Good", "Year2001", "Year2002"]
    assert sorted(out) == [1, 2, 3, 4]
    assert [out[k]["x"] for k in (1, 2, 3, 4)] == [1.0, 4.0, 4.0, 4.0]
    assert [out[k]["cut1:Good"] for k in (1, 2, 3, 4)] == [0.0, 1.0, 1.0, 1.0]
    assert [out[k]["Year2001"] for k in (1, 2, 3, 4)] == [1.0, 0.0, 0.0, 0.0]
    assert [out[k]["y"] for k in (1, 2, 3, 4)] == [1.0, 0.0, 1.0, 0.0]


def test_cleaner_scale_and_median(dirty):
    cleaner = clean.TableCleaner(MAP, no_impute=["y"], interval_scale="std", interval_fill="median", keep=["k"])
    values = np.array([1.0, 4.0, 4.0, 4.0, 7.0, 4.0])
    out = {r.k: r.x for r in cleaner.fit_transform(dirty).collect()}
    assert math.isclose(out[1], (1.0 - values.mean()) / values.std())


def test_bad_maps(dirty):
    with pytest.raises(ValueError):
        clean.check_map(dirty, {"nope": Attr("id")})
    with pytest.raises(ValueError):
        clean.check_map(dirty, {"cut": Attr("interval", (0, 1))})
    with pytest.raises(ValueError):
        Attr("binary", ("a",))


def test_dedup_with_a_hot_key(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"))
    kept = reshape.dedup(df, ["key"], ["id"])
    assert kept.count() == 335 and kept.filter("key = 'hot'").first().id == 1


def test_merge_report(spark):
    a, b = spark.range(5), spark.range(3, 9)
    report = {r.table: r.n for r in reshape.merge_report({"a": a, "b": b}, reshape.union_all(a, b).distinct()).collect()}
    assert report == {"a": 5, "b": 6, "merged": 9, "dropped": 2}


def test_split_top_with_ties(spark):
    df = spark.createDataFrame([(i, i // 3) for i in range(20)], "id int, n int")
    top = {r.id for r in profile.split_top(df, "n", ["id"], 4).filter("in_top").collect()}
    assert top == {18, 19, 15, 16}


def test_crosstab_totals(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), (None, "x")], "a string, b string")
    rows = {(r.a, r.b): (r.n, round(r.pct, 3)) for r in reshape.crosstab(df, "a", "b").collect()}
    assert rows["a", "y"] == (2, 66.667) and rows["a", "TOTAL"] == (3, 60.0) and rows[None, "TOTAL"] == (1, 20.0)


def test_scan_rules(spark):
    with pytest.raises(ValueError):
        tables.scan_table(spark, "/nowhere", fmt="csv")
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id int, v double")
    assert tables.nan_to_null(df).filter("v is null").count() == 1


def test_topic_assign_takes_the_last_on_ties(spark):
    df = spark.createDataFrame([(1, [0.4, 0.2, 0.4]), (2, [0.9, 0.05, 0.05])], "id int, weights array<double>")
    got = {r.id: (r.topic, r.prob) for r in topics.topic_assign(df, "id").collect()}
    assert got == {1: (2, 0.4), 2: (0, 0.9)}


@pytest.fixture(scope="module")
def planted(spark):
    """Two groups of documents with disjoint words."""
    rng = random.Random(1)
    sides = [["apple", "pear", "plum", "fig"], ["iron", "zinc", "lead", "tin"]]
    data = [(i, " ".join(rng.choice(sides[i % 2]) for _ in range(20))) for i in range(60)]
    return spark.createDataFrame(data, "id int, text string").cache()


def sides_of(assigned):
    found = {}
    for r in assigned.collect():
        found.setdefault(r.id % 2, set()).add(r.topic)
    return found


@pytest.mark.parametrize("kl", [False, True])
def test_nmf_finds_planted_topics(spark, planted, kl):
    counts = terms.doc_term(terms.tokenize(planted, "id"), "id")
    weights = terms.tfidf(counts, "id", 60)
    fit = topics.topics_nmf_kl if kl else topics.topics_nmf
    found = fit(weights, "id", 2, max_iter=12, alpha=0.0)
    losses = found.info["losses"]
    assert all(b <= a * (1 + 1e-9) for a, b in zip(losses, losses[1:]))
    groups = sides_of(topics.topic_assign(found.docs, "id"))
    assert all(len(g) == 1 for g in groups.values()) and groups[0] != groups[1]
    w = {r.id: np.array(r.weights) for r in found.docs.collect()}
    h = {}
    for r in found.terms.collect():
        h.setdefault(r.term, np.zeros(2))[r.topic] = r.weight
    a = {(r.id, r.term): r.tfidf for r in weights.collect()}
    model = {(i, t): float(w[i] @ h[t]) for i in w for t in h}
    if kl:
        want = sum(v * math.log(v / model[k]) - v for k, v in a.items()) + sum(model.values())
    else:
        want = 0.5 * sum((a.get(k, 0.0) - m) ** 2 for k, m in model.items())
    assert losses[-1] == pytest.approx(want, rel=1e-6)


def test_lda_and_svd(spark, planted):
    vectors = topics.doc_weights(planted, "id")
    vocabulary = sorted({r.term for r in vectors.collect()})
    matrix = np.zeros((60, len(vocabulary)))
    for r in vectors.collect():
        matrix[r.id, vocabulary.index(r.term)] = r.value
    idf = {t: math.log(61 / (1 + sum(t in r.text.split() for r in planted.collect()))) + 1 for t in vocabulary}
    first = planted.filter("id = 0").first().text.split()
    assert np.allclose(matrix[0], [first.count(t) * idf[t] for t in vocabulary])
    svd = topics.topics_svd(vectors, "id", 3)
    assert np.allclose(svd.info["singular_values"], np.linalg.svd(matrix)[1][:3], rtol=1e-6)
    scores = np.array([r.weights for r in svd.docs.orderBy("id").collect()])
    assert np.allclose(np.abs(scores), np.abs((np.linalg.svd(matrix, full_matrices=False)[0] * np.linalg.svd(matrix)[1][:8])[:, :3]), atol=1e-5)
    lda = topics.topics_lda(vectors, "id", 2, max_iter=30)
    assert all(abs(sum(r.weights) - 1) < 1e-9 for r in lda.docs.collect())
    groups = sides_of(topics.topic_assign(lda.docs, "id"))
    assert all(len(g) == 1 for g in groups.values()) and groups[0] != groups[1]
    assert topics.topic_terms(lda, 3).count() == 6


def test_text_clusters(spark, planted):
    found = topics.text_clusters_em(planted, "id", k=2, min_df=4, dims=2)
    assert sorted(r.n for r in found.sizes.collect()) == [30, 30]
    sides = {frozenset(r.terms) for r in found.terms.groupBy("cluster").agg(F.collect_set("term").alias("terms")).collect()}
    assert all({"apple", "pear"} <= s or {"iron", "zinc"} <= s for s in sides)
    assert found.distances.count() == 1 and found.distances.first().distance > 1


def test_repeated_lookup_keys_are_rejected(spark):
    from loomstat.operators import reshape

    df = spark.createDataFrame([("a",), ("b",)], "k string")
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "f string, t string")
    with pytest.raises(ValueError, match="more than once"):
        reshape.map_values(df, "k", twice)


def test_row_and_table_sentiment_agree(spark):
    docs = corpus(spark)
    lexicon = {"the": 2.0, "ra": -3.0, "wb": 1.0}
    table = spark.createDataFrame(list(lexicon.items()), "term string, score double")
    row = sorted(map(str, sentiment.sentiment_scores(docs, lexicon, "id").collect()))
    assert row == sorted(map(str, sentiment.sentiment_scores(docs, table, "id").collect()))


def test_dedup_keeps_the_first_by_hash(spark):
    from loomstat.operators import reshape

    rows = [(i, "same" if i % 3 else f"t{i % 4}", i % 2) for i in range(50)] + [(77, None, 1), (60, None, 0), (0, "t0", 0), (0, "t0", 0)]
    df = spark.createDataFrame(rows, "id long, text string, v int")
    got = reshape.dedup(df, ["text"], ["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    want = {}
    for i, t, v in sorted(rows):
        want.setdefault(t, (i, t, v))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.values(), key=repr)
