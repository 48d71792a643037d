"""The registered queries of the operators over the standard tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import (
    alignment, language_model, licenses, line_spread, mixing, neighbours, personal_data, pieces, quality, simhash, spelling, toxicity, vector_groups,
)
from loomstat.llm.catalog import ORACLES, QUERIES, query, table
from loomstat.llm.common import held_out

__all__ = ["ORACLES", "QUERIES"]

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"

MIX_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighted AS (
    SELECT source, source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
        sum(source_size) OVER () AS total
    FROM sources
), filled AS (
    SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
        sum(2.0::DOUBLE * source_size) OVER w AS full_words, sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight DESC, source NULLS FIRST) - weight AS open_weight
    FROM weighted WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST)
), levels AS (
    SELECT max(level) AS level FROM (
        SELECT (1.5::DOUBLE * total - full_words) / open_weight AS level FROM filled WHERE open_weight > 0 AND ratio <= (1.5::DOUBLE * total - full_words) / open_weight
        UNION ALL SELECT 1.5::DOUBLE * max(total) / sum(weight) FROM weighted)
), targets AS (
    SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight)::DOUBLE AS target FROM weighted, levels
), rates AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS chance
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rates
"""


@query(MIX_SQL)
def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken")

@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scores = toxicity.score(docs, model)
    flagged = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scores.select("doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "score", flagged)


@query()
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Own and inherited licence of every document.

    The table has no paths, so each document gets one: its source is the
    repository, hundreds and ten thousands of ids are directories, and the first
    document of each hundred stands as that directory's LICENSE file (the first
    of ten thousand as that of the directory above).
    """
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    upper, lower = F.floor(F.col("doc_id") / 10_000), F.floor(F.col("doc_id") / 100)
    inside = F.when(F.col("doc_id") % 10_000 == 0, "LICENSE").when(F.col("doc_id") % 100 == 0, F.concat_ws("/", lower, F.lit("LICENSE")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), upper, F.coalesce(inside, F.concat_ws("/", lower, F.concat("doc_id", F.lit(".txt")))))
    scanned = licenses.scan_licenses(docs.select("doc_id", "text", path.alias("path")))
    return scanned.select("doc_id", "path", "own_license", F.round("score", 6).alias("score"), "license", "license_dir")


SPREAD_SQL = r"""
WITH lines AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents
), spread AS (
    SELECT line, min(doc_id) AS first_doc FROM lines WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT coalesce('s' || source, 'n')) >= 5
), firsts AS (
    SELECT l.line, l.doc_id, min(l.pos) AS pos FROM lines l JOIN spread s ON l.line = s.line AND l.doc_id = s.first_doc GROUP BY l.line, l.doc_id
), marked AS (
    SELECT l.doc_id, l.line, l.pos, s.line IS NOT NULL AND f.line IS NULL AS cut
    FROM lines l LEFT JOIN spread s ON l.line = s.line LEFT JOIN firsts f ON l.line = f.line AND l.doc_id = f.doc_id AND l.pos = f.pos
), rebuilt AS (
    SELECT doc_id, sum(cut::INT)::BIGINT AS n_cut, coalesce(string_agg(CASE WHEN cut THEN NULL ELSE line END, chr(10) ORDER BY pos), '') AS text FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(r.n_cut, 0)::BIGINT AS n_cut, coalesce(len(r.text), 0)::BIGINT AS n_chars, sha256(coalesce(r.text, '')) AS text_sha256
FROM documents d LEFT JOIN rebuilt r ON d.doc_id = r.doc_id
"""


@query()
def op3_piece_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document by the shortest path, and whether decoding gives the text back."""
    return pieces.encode_digest(table(spark, folder, "documents"), pieces.read_model(PIECE_MODEL))


@query(SPREAD_SQL)
def op8_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that stand on many sites."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    cut = line_spread.cut_spread_lines(docs, count="n_cut")
    kept = F.coalesce("text", F.lit(""))
    return cut.select("doc_id", "n_cut", F.length(kept).cast("long").alias("n_chars"), F.sha2(kept, 256).alias("text_sha256"))


@query()
def op4_vector_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate links and groups of all embeddings with equal labels."""
    return vector_groups.group_vectors(table(spark, folder, "embeddings"))


@query()
def op5_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors of greatest inner product for every twentieth embedding."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op6_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Language-model score of every document."""
    return language_model.score_documents(table(spark, folder, "documents"))


@query()
def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digests of the personal data in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = personal_data.find_personal_data(docs).select("doc_id", "spans")
    base = [k.name for k in personal_data.KINDS if k.base]
    more = [k.name for k in personal_data.KINDS if not k.base]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(personal_data.digest(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        personal_data.digest(F.col("spans")).alias("spans"),
        *[count(k) for k in more],
    )


@query()
def op9_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate group of every document by SimHash."""
    return simhash.group_near_duplicates(table(spark, folder, "documents"))


@query()
def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of the byte-level and the piece vocabulary fall together in every document."""
    byte_json, piece_model = Path(BYTE_MODEL).read_bytes(), Path(PIECE_MODEL).read_bytes()
    return alignment.align_tokenizers(table(spark, folder, "documents"), byte_json, piece_model)


@query()
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Near words, frequent form and root of every word of the documents."""
    return spelling.group_variants(table(spark, folder, "documents"))


@query()
def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    scores = quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    flagged = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scores.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", flagged)
