"""From raw documents to encoded training data: five stages, each one operator over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import line_spread, mixing, pieces, simhash, toxicity
from loomstat.llm.queries import PIECE_MODEL
from loomstat.session import work_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.3 or more go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sources stay in the first document only; n_chars follows the text."""
    cut = line_spread.cut_spread_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest doc_id."""
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or thinned out until their sources have the target weights."""
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    coded = pieces.encode(docs, pieces.read_model(PIECE_MODEL))
    return coded.select("doc_id", "lang", "source", "pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_lines),
    ("simhash_dedup", keep_first),
    ("mixing", mix),
    ("encoding", encode),
]

# Toxicity is fitted and SimHash needs XXH64, so SQL has no twin; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole document table; each result is stored in the shared folder before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
