"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters are a binary vector with a place for every letter and how
manyth it is. One inserted, deleted or replaced letter changes at most two
places, so near words have vectors within Hamming distance two. The places are
cut into PARTS classes by letter; two differing places touch at most two
classes, so near words agree on some PARTS - 2 of them. A signature names such a
choice of classes and the letters that the word has in them, and all choices
are enumerated: near words always share one.

One edit also leaves the first or the last few letters as they are, so each
signature is joined together with either end. That keeps the words of a common
signature apart, and verifying what meets is an edit distance of one.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.session import cut_lineage

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Classes that the letters of words are cut into.
PARTS = 5
# One in so many different (document, word) pairs loses a letter.
MISSPELT = 199
LEAST_LETTERS, LEAST_COUNT, FORM_RATIO = 6, 5, 5


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case, any other letter as it is; words of plain ASCII take the cheaper way."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): how often the whole texts hold each word, of words that are long and frequent enough.

    Words are runs of Latin letters with A-Z in lower case. Where MISSPELT
    divides the crc32 of ``doc_id:word``, the word loses the letter at that
    number modulo its length in this document. Null texts have no words, and a
    null doc_id counts as the empty text. Occurrences are summed by document
    and word before anything is hashed, and by word before the shuffle.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d")
    runs = docs.select(doc_id, F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_letters).select("d", lower_ascii(F.col("run")).alias("run"))
    hashed = F.crc32(F.concat_ws(":", "d", "run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    short = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    words = runs.withColumn("h", hashed).withColumn("at", at).select(F.when(F.col("h") % MISSPELT == 0, short).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.char_length("word") >= least_letters))


def part_letters(word: Column, parts: int = PARTS) -> Column:
    """Per class, the letters of the word that belong to it, in order, repeats included."""
    letters = F.array_sort(F.split(word, ""))
    return F.array(*[F.array_join(F.filter(letters, lambda c: F.ascii(c) % parts == part), "") for part in range(parts)])


def near_pairs(words: DataFrame, least_letters: int = LEAST_LETTERS, parts: int = PARTS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words exactly one edit apart.

    ``words`` has distinct (word, n). Each word sends one row for every choice
    of ``parts - 2`` classes and either end; ends are half as long as the
    shortest words, so one edit cannot touch both (empty where words may have
    one letter). Rows meet by the hash of choice, letters and end; pairs that
    do not hold an edit distance of one are dropped inside the join, before
    they become rows.
    """
    end = least_letters // 2
    chosen = list(combinations(range(parts), parts - 2))
    cut = words.select("word", "n", F.char_length("word").alias("size"), part_letters(F.col("word"), parts).alias("part"))
    cut = cut.withColumn("head", F.substring("word", 1, end)).withColumn("tail", F.expr(f"right(word, {end})"))
    keys = [
        F.xxhash64(F.lit(f"{side}{number}"), F.col(side), *[F.col("part")[p] for p in choice])
        for number, choice in enumerate(chosen)
        for side in ("head", "tail")
    ]
    posted = cut.select("word", "n", "size", F.explode(F.array(*keys)).alias("key"))
    a, b = posted.alias("a"), posted.alias("b")
    close = F.abs(F.col("a.size") - F.col("b.size")) <= 1
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word")) & close & (F.levenshtein("a.word", "b.word", 1) == 1)
    met = a.join(b, near).select(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")).distinct()
    return met.union(met.select("near", "near_n", "word", "n"))


def follow_forms(formed: DataFrame) -> DataFrame:
    """(word, root): where following forms from each word with a form ends.

    ``formed`` has distinct words with their form. A form is at least
    FORM_RATIO times as frequent, so there are no circles; each round doubles the
    steps taken.
    """
    now = cut_lineage(formed.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("by"), F.col("root").alias("beyond"))
        moved = cut_lineage(now.join(on, now["root"] == on["by"], "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def group_variants(docs: DataFrame) -> DataFrame:
    """One row per word of the documents: word, form, root (string), n, n_near, form_n (long).

    ``docs`` needs ``doc_id`` and ``text``; other columns, whatever their names, are
    not read. A word's form is its near word with the greatest n (ties: the
    first in code-point order) if that is at least FORM_RATIO times its own n,
    else null; root is the end of the chain of forms. Repeated rows count as often
    as they stand there. Null and empty texts add nothing, texts of any length
    are read whole, and an empty table gives no rows.
    """
    words = cut_lineage(word_counts(docs))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_pairs(words).groupBy(F.col("word").alias("near_word")).agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, F.col("word") == F.col("near_word"), "left")
    enough = -F.col("best.less") >= F.col("n") * FORM_RATIO
    rows = cut_lineage(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    roots = follow_forms(rows.where("form is not null")).withColumnRenamed("word", "of")
    return rows.join(roots, F.col("word") == F.col("of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
