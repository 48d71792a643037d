"""Column expressions over text. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"\p{L}+"
PHRASE_MARK = "\u0001"


def word_array(text: Column) -> Column:
    """Lower-case runs of letters, in reading order; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), F.lit(0))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    ``body`` uses it (projections may be merged, lambda variables are not)."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _grams_of(words: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def gram_array(words: Column, n_min: int = 1, n_max: int = 2) -> Column:
    """All word n-grams of an array, built inside the row (no shuffle)."""
    if not 1 <= n_min <= n_max:
        raise ValueError("need 1 <= n_min <= n_max")
    if n_max == 1:
        return words
    return bind(words, lambda w: F.concat(*[w if n == 1 else _grams_of(w, n) for n in range(n_min, n_max + 1)]))


def join_phrases(words: Column, phrases: Iterable[str]) -> Column:
    """Glue listed two-word phrases into one token, left to right.

    The array is laid out as one space-separated string so that a single
    regular expression finds the phrases; the scan is left to right and
    never lets two matches share a word.
    """
    pairs = sorted({" ".join(p.lower().split()) for p in phrases})
    if not pairs:
        return words
    if any(len(p.split(" ")) != 2 for p in pairs):
        raise ValueError("phrases must have exactly two words")
    either = "|".join(re.escape(p).replace(r"\ ", " ") for p in pairs)
    pattern = rf"(?<= )(?=(?:{either}) )(\S+) (\S+)"
    padded = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    glued = F.trim(F.regexp_replace(padded, pattern, f"$1{PHRASE_MARK}$2"))
    return F.filter(F.split(glued, " "), lambda w: w != "")


def recode_words(words: Column, single: Mapping[str, str]) -> Column:
    """Replace words by their canonical form where one is given."""
    if not single:
        return words
    table = F.create_map(*[F.lit(x) for kv in sorted(single.items()) for x in kv])
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))


def occurrences(text: Column, term: str) -> Column:
    """How often ``term`` occurs in the lower-cased text, also inside words."""
    needle = term.lower()
    if not needle:
        raise ValueError("empty term")
    low = F.lower(F.coalesce(text, F.lit("")))
    removed = F.length(low) - F.length(F.replace(low, F.lit(needle), F.lit("")))
    return (removed / F.lit(len(needle))).cast("bigint")


def contains_word(text: Column, word: str) -> Column:
    return text.rlike(r"\b" + re.escape(word) + r"\b")


def per_thousand(count: Column, length: Column) -> Column:
    """``1000 * count / length``; null where the length is zero."""
    return F.lit(1000.0) * count / F.nullif(length, F.lit(0))
