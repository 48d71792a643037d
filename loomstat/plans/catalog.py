"""Registry of named queries over the standard tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name; without ``sql`` there is no twin."""

    def add(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"duplicate query {fn.__name__}")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns so that two engines print the same digits."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.round(F.col(f"`{c}`").cast("double"), digits).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


# Literal inputs of the text queries: a lexicon and stop words of frequent
# words of the document table, and a two-word phrase that occurs in it.
LEXICON = {
    "the": 1.0, "of": -1.0, "and": 2.0, "to": -2.0, "in": 3.0, "de": -3.0, "la": 1.0, "der": -1.0,
    "is": 4.0, "that": -4.0, "en": 2.0, "it": 5.0, "und": -5.0, "was": -2.0,
}
STOP_WORDS = ["the", "of", "and", "to", "in", "a", "de", "la", "der", "die", "en", "is", "und", "le", "que"]
SYNONYMS = {"of the": "ofthe", "le": "la", "die": "der", "les": "la"}
LEMMAS = {"ist": "sein", "sind": "sein", "are": "be", "is": "be", "was": "be"}
KEYWORDS = ["the", "der", "que"]

WORDS_SQL = r"unnest(regexp_extract_all(lower(text), '\p{L}+'))"


def values_sql(mapping: dict, names: str) -> str:
    """A VALUES list as a derived table."""

    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"

    rows = ", ".join(f"({lit(k)}, {lit(v)})" for k, v in mapping.items())
    return f"(VALUES {rows}) AS {names}"


def list_sql(items) -> str:
    return "(" + ", ".join("'" + i + "'" for i in items) + ")"
