"""Toxicity by weak supervision.

Many voters (word lists, patterns, and words and word beginnings mined from
labelled rows) mark a document. A generative label model estimates from all
documents how often each voter fires on toxic and on clean ones and how voters
hang together, and turns votes into a posterior. A linear classifier learns
from posteriors, and scores come from the text alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import col, held_out
from loomstat.session import cut_lineage

# At most about this many labelled rows are read to mine voters and to fit the classifier.
FIT_ROWS = 20_000
# Features of the classifier and members of each mined voter.
FEATURES = 4096
MINED_VOTERS = 6
LEAST_DOCS = 4
ROUNDS = 12
WORD = re.compile(r"\w+")
# The last two voters: what a training label says of its document. They abstain elsewhere.
ANNOTATORS = ("said_toxic", "said_clean")
# Words remembered per worker; a full cache starts afresh.
CACHE = 150_000

# Word lists of the hand-made voters.
LEXICA = {
    "insult": "idiot idiots moron morons imbecile loser losers clown clowns fool fools jerk creep scum trash vermin pig rat",
    "demean": "stupid dumb worthless pathetic disgusting useless ugly filthy vile revolting ridiculous inferior subhuman",
    "threat": "kill murder die hurt destroy strangle beat shoot stab hang burn",
    "profane": "damn hell crap bastard bitch shit fuck fucking ass asshole",
    "hate": "hate despise loathe detest exterminate deport",
    "german": "dumm dummkopf trottel abschaum widerlich ekelhaft wertlos versager arschloch",
    "french": "stupide imbécile crétin ordure dégoûtant minable débile connard",
    "spanish": "estúpido imbécil basura asqueroso inútil patético payaso cabrón",
}
PATTERNS = {
    "at_you": r"\b(?:you|your|you're|du|tu)\W+(?:\w+\W+){0,3}?(?:idiot|moron|loser|clown|scum|trash|stupid|pathetic|worthless|disgusting)",
    "go_away": r"\b(?:shut up|go die|drop dead|get lost|halt die klappe|ta gueule|cállate)\b",
    "shouting": r"!{3,}",
    "disguised": r"\b(?:[i1!]d[i1!][o0]t|m[o0]r[o0]n|[s5\$]tup[i1!]d|l[o0][s5\$]er|[s5\$]cum|tr[a@][s5\$]h|cl[o0]wn|p[a@]thet[i1!]c)\b",
}
BEGINNINGS = (4, 5, 6)


def word_features(word: str) -> tuple[str, ...]:
    """The word itself and its beginnings, which catch compounds and endings."""
    return (word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) > n])


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass
class Voters:
    """All voters: word lists, patterns and mined features, each a bit of the vote mask."""

    mined: list[list[str]] = field(default_factory=list)

    def __post_init__(self):
        self.names = [*LEXICA, *PATTERNS, "two_hits", *[f"mined_{i}" for i in range(len(self.mined))], *ANNOTATORS]
        bits = {name: 1 << i for i, name in enumerate(self.names)}
        self.by_feature: dict[str, int] = {}
        for name, words in LEXICA.items():
            for word in words.split():
                self.by_feature[word] = self.by_feature.get(word, 0) | bits[name]
        for i, features in enumerate(self.mined):
            for feature in features:
                self.by_feature[feature] = self.by_feature.get(feature, 0) | bits[f"mined_{i}"]
        self.listed = sum(bits[name] for name in LEXICA)
        self.patterns = [(re.compile(p), bits[name]) for name, p in PATTERNS.items()]
        self.two_hits = bits["two_hits"]
        self.known: dict[str, int] = {}

    def mask(self, text: str | None) -> int:
        """The votes of a text as a bit mask."""
        votes = hits = 0
        known, by_feature = self.known, self.by_feature
        lower = (text or "").lower()
        for word in set(WORD.findall(lower)):
            own = known.get(word)
            if own is None:
                if len(known) >= CACHE:
                    known.clear()
                own = 0
                for feature in word_features(word):
                    own |= by_feature.get(feature, 0)
                known[word] = own
            if own:
                votes |= own
                hits += bool(own & self.listed)
        for pattern, bit in self.patterns:
            if pattern.search(lower):
                votes |= bit
        return votes | (self.two_hits if hits > 1 else 0)


def training_labels(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(id, label) of the rows that may be learnt from; an id labelled twice is toxic if either label says so."""
    known = labels.select(col(doc_id).cast("long").alias("id"), col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"), 4))
    return known.groupBy("id").agg(F.max("label").alias("label"))


def labelled_sample(docs: DataFrame, known: DataFrame, doc_id: str, text: str, rows: int = FIT_ROWS) -> DataFrame:
    """(id, text, label) of labelled training rows, about ``rows`` at most, chosen by a hash of the id.

    The chosen ids are bounded by ``rows``, so they are broadcast to the scan.
    """
    total = known.count()
    share = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, rows / max(total, 1)))
    texts = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text"))
    return cut_lineage(texts.join(F.broadcast(known.where(share)), "id").select("id", "text", "label"))


def feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): documents of each class that hold the feature, counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                for feature in {f for w in words_of(text.as_py()) for f in word_features(w)}:
                    seen.setdefault(feature, [0, 0])[1 - label] += 1
            columns = [pa.array(list(seen), pa.string()), *[pa.array([c[i] for c in seen.values()], pa.int64()) for i in (0, 1)]]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "clean"])

    counted = sample.select("text", "label").mapInArrow(count, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def mine(sample: DataFrame, features: int = FEATURES) -> list[tuple[str, float]]:
    """The features that tell toxic from clean best, at most ``features``: (feature, log odds), best first.

    Ranked by the signed root of the log-likelihood ratio of their 2x2 table.
    """
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []
    share = n1 / (n1 + n0)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    held = F.col("toxic") + F.col("clean")
    gain = term(F.col("toxic"), held * share) + term(F.col("clean"), held * (1 - share)) + term(n1 - F.col("toxic"), (n1 + n0 - held) * share + 1e-9)
    gain = gain + term(n0 - F.col("clean"), (n1 + n0 - held) * (1 - share) + 1e-9)
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
    ranked = feature_counts(sample).where(held >= LEAST_DOCS).select("feature", gain.alias("gain"), odds.alias("odds"))
    return [(r["feature"], r["odds"]) for r in ranked.orderBy(F.desc("gain"), "feature").limit(features).collect()]


def mined_voters(mined: Sequence[tuple[str, float]], voters: int = MINED_VOTERS) -> list[list[str]]:
    """Clearly toxic features in tiers of a hundred by rank, one voter each, so that voters differ in accuracy."""
    strong = [f for f, odds in mined if odds > 2.0][: 100 * voters]
    return [strong[100 * i : 100 * (i + 1)] for i in range(voters)]


def votes(docs: DataFrame, voters: Voters, doc_id: str, text: str) -> DataFrame:
    """(id, votes): the vote mask of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(voters.mined)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Voters(shared.value)
        for batch in batches:
            masks = pa.array([own.mask(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), masks], ["id", "votes"])

    return docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).mapInArrow(vote, "id long, votes long")


@dataclass
class LabelModel:
    """P(toxic), and for each voter how often it fires on toxic and on clean documents; weights share what correlated voters say."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    weights: np.ndarray

    def terms(self) -> tuple[float, np.ndarray]:
        """Log odds without votes, and what each vote adds."""
        on = np.log(self.toxic / self.clean)
        off = np.log((1 - self.toxic) / (1 - self.clean))
        off[-len(ANNOTATORS) :] = 0.0
        return math.log(self.prior / (1 - self.prior)) + float((self.weights * off).sum()), self.weights * (on - off)

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        base, add = self.terms()
        return 1 / (1 + np.exp(-(base + fires(masks, len(add)) @ add)))


def fires(masks: np.ndarray, m: int) -> np.ndarray:
    """0/1 matrix of masks by voters."""
    return (masks[:, None] >> np.arange(m) & 1).astype(float)


def joint_counts(patterns: DataFrame, model: LabelModel, m: int) -> tuple[np.ndarray, np.ndarray]:
    """How many documents, and how much posterior, every pair of voters marks together; the last index stands for all documents."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, m + 1, m + 1))
        for batch in batches:
            masks, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            on = np.column_stack([fires(masks, m), np.ones(len(masks))])
            total[0] += on.T @ (on * n[:, None])
            total[1] += on.T @ (on * (n * model.posterior(masks))[:, None])
        cells = np.arange((m + 1) ** 2)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[0].ravel()), pa.array(total[1].ravel())], ["cell", "n", "p"])

    summed = patterns.select("votes", "n").mapInArrow(partial, "cell long, n double, p double").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    both = np.zeros((2, (m + 1) ** 2))
    for row in summed.collect():
        both[:, row["cell"]] = row["n"], row["p"]
    return both[0].reshape(m + 1, m + 1), both[1].reshape(m + 1, m + 1)


def fit_label_model(masks: DataFrame, names: Sequence[str], rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over the votes of all documents.

    Equal masks are first folded to one row with a count. Every round is one
    aggregate of m x m sums (m voters): posterior-weighted firing counts give
    the accuracies, posterior-weighted joint counts the correlations inside each
    class. A voter whose firing goes along with others' inside a class has its
    weight divided by one plus the sum of these correlations.

    It starts from voters that fire on 30 % of toxic documents and as often on
    clean ones as they fire in all; a voter never counts as worse than chance.
    Training labels are two more voters, which start as right in 97 % of cases
    and keep their full weight.
    """
    sayers = slice(len(names) - len(ANNOTATORS), len(names))
    m = len(names)
    patterns = cut_lineage(masks.groupBy("votes").agg(F.count(F.lit(1)).alias("n")))
    blank = LabelModel(0.1, np.full(m, 0.3), np.full(m, 0.1), np.ones(m))
    joint, _ = joint_counts(patterns, blank, m)
    total = joint[m, m]
    rate = (joint[m, :m] + 0.5) / (total + 1)
    model = LabelModel(0.1, np.maximum(0.3, rate * 1.5).clip(1e-4, 0.95), (rate * 0.8).clip(1e-5, 0.9), np.full(m, 1 / math.sqrt(m)))
    model.toxic[sayers], model.clean[sayers], model.weights[sayers] = (0.97, 0.03), (0.03, 0.97), 1.0
    for _ in range(rounds if total else 0):
        joint, toxic = joint_counts(patterns, model, m)
        n1, n0 = max(toxic[m, m], 1.0), max(total - toxic[m, m], 1.0)
        correlation = np.zeros((m, m))
        for counts, n in ((toxic[:m, :m], n1), ((joint - toxic)[:m, :m], n0)):
            rates = ((np.diag(counts) + 0.5) / (n + 1)).clip(1e-9, 1 - 1e-9)
            spread = np.sqrt(np.outer(rates * (1 - rates), rates * (1 - rates)))
            correlation = np.maximum(correlation, ((counts / n - np.outer(rates, rates)) / spread).clip(0, 1))
        np.fill_diagonal(correlation, 0)
        correlation[sayers] = correlation[:, sayers] = 0
        on1 = ((np.diag(toxic)[:m] + 0.5) / (n1 + 1)).clip(1e-4, 0.99)
        on0 = ((np.diag(joint - toxic)[:m] + 0.5) / (n0 + 1)).clip(1e-5, 0.99)
        model = LabelModel(min(max(n1 / total, 0.005), 0.5), np.maximum(on1, on0), np.minimum(on0, on1), 1 / (1 + correlation.sum(axis=1)))
        model.toxic[sayers], model.clean[sayers] = on1[sayers], on0[sayers]
    return model


@dataclass
class ToxicityModel:
    """What scoring needs: features with weights, an intercept, and the voters and label model that made them."""

    features: dict[str, int]
    weights: np.ndarray
    intercept: float
    voters: Voters
    label_model: LabelModel

    def scorer(self):
        known: dict[str, tuple[int, ...]] = {}
        features, weights, intercept = self.features, self.weights, self.intercept

        def score(text: str | None) -> float:
            active: set[int] = set()
            for word in words_of(text):
                own = known.get(word)
                if own is None:
                    if len(known) >= CACHE:
                        known.clear()
                    own = known[word] = tuple(features[f] for f in word_features(word) if f in features)
                if own:
                    active.update(own)
            z = intercept + float(weights[sorted(active)].sum())
            return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

        return score


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = FIT_ROWS
) -> ToxicityModel:
    """Fit voters, label model and classifier.

    Labels come from rows whose crc32(doc_id as text) mod 4 is not 2. The sample (``rows``) bounds mining and the classifier; the
    label model reads the votes of all documents. Without both classes among
    the labels the classifier is the label model's prior alone.

    Null and empty texts have no votes. Rows that repeat an id each count; an id labelled twice is toxic if either label says so. Only the
    named columns are read, so others may have any name. Ids must be castable to long; null ids are never learnt from.
    """
    known = training_labels(labels, doc_id, label)
    sample = labelled_sample(docs, known, doc_id, text, rows)
    mined = mine(sample)
    voters = Voters(mined_voters(mined))
    said = F.when(F.col("label") == 1, 1 << voters.names.index("said_toxic")).when(F.col("label") == 0, 1 << voters.names.index("said_clean")).otherwise(0)
    marked = votes(docs, voters, doc_id, text).join(known, "id", "left").select(F.col("votes").bitwiseOR(said.cast("long")).alias("votes"))
    model = fit_label_model(marked, voters.names)
    if not mined:
        return ToxicityModel({}, np.zeros(0), math.log(model.prior / (1 - model.prior)), voters, model)
    features = {f: i for i, (f, _) in enumerate(mined)}
    shared = docs.sparkSession.sparkContext.broadcast((set(features), voters.mined))

    toxic_bit, clean_bit = (1 << voters.names.index(a) for a in ANNOTATORS)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, mined_lists = shared.value
        own = Voters(mined_lists)
        for batch in batches:
            active, masks = [], []
            for value in batch.column(0):
                content = value.as_py()
                active.append(sorted({f for w in words_of(content) for f in word_features(w) if f in index}))
                masks.append(own.mask(content))
            said = np.where(batch.column(1).to_numpy(zero_copy_only=False) == 1, toxic_bit, clean_bit)
            posterior = model.posterior(np.array(masks, dtype=np.int64) | said)
            yield pa.RecordBatch.from_arrays([pa.array(active, pa.list_(pa.string())), pa.array(posterior)], ["active", "p"])

    ready = sample.select("text", "label").mapInArrow(inputs, "active array<string>, p double")
    vectors = CountVectorizerModel.from_vocabulary(list(features), inputCol="active", outputCol="features", binary=True).transform(ready)
    # A posterior is learned as two weighted rows, one of each class.
    two = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - F.col("p")).alias("w"))))
    training = vectors.select("features", two.alias("t")).select("features", "t.y", "t.w").where("w > 0.001")
    linear = LogisticRegression(labelCol="y", weightCol="w", regParam=1e-4, maxIter=60, standardization=False).fit(training)
    return ToxicityModel(features, linear.coefficients.toArray(), float(linear.intercept), voters, model)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, repeated rows included; the score sees the text only. Null and empty texts have the score of no
    word at all; an empty table gives no row; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.intercept, model.voters.mined, model.label_model))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, intercept, mined, label_model = shared.value
        own = Voters(mined)
        rate = ToxicityModel(features, weights, intercept, own, label_model).scorer()
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([rate(t) for t in texts], pa.float64())], ["doc_id", "score"])

    return docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text")).mapInArrow(scored, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns. Texts are scored in place, so nothing is shuffled. Null and
    empty texts have the score of no word at all and stay unless that reaches the threshold; repeated rows share one fate."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.intercept, model.voters.mined, model.label_model))

    @F.pandas_udf("double")
    def rated(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, weights, intercept, mined, label_model = shared.value
        rate = ToxicityModel(features, weights, intercept, Voters(mined), label_model).scorer()
        for texts in batches:
            yield texts.map(rate)

    return docs.where(rated(col(text)) < threshold)
