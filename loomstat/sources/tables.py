"""Scans and sinks. Schemas are given, never inferred from the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.session import cut_lineage


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """One table. Parquet carries its schema; text formats must be given one."""
    if schema is None and fmt not in ("parquet", "orc"):
        raise ValueError(f"{fmt} files need an explicit schema")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def scan_columns(spark: SparkSession, path: str, columns: Sequence[str], **kwargs) -> DataFrame:
    """Only the named columns; the pruning reaches the file reader."""
    return scan_table(spark, path, **kwargs).select(*columns)


def spread_rows(df: DataFrame, *key: str) -> DataFrame:
    """Deal the rows of a narrow scan over all cores by their key.

    A small file with a single row group is read by one task, and row-heavy
    work behind it (tokenising, markup removal) would stay in that task. An
    input that already has as many splits as there are cores is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *key)


def keep_packed(df: DataFrame, rows_per_task: int = 100_000, rows_to_share: int | None = None) -> tuple[DataFrame, int]:
    """Store a training table for repeated passes; returns it and its row count.

    The rows are checkpointed in the shared folder, so no pass plans or
    recomputes the features again and a lost executor costs a re-read, and are
    cached on top. Every pass pays for each task, so a table with few rows per
    partition is read in fewer, fuller tasks; a large one keeps its partitions.
    Where a pass does much with a row, ``rows_to_share`` is how many are worth
    a task of their own as long as cores are free.
    """
    stored = cut_lineage(df)
    n = stored.count()
    wanted = max(1, -(-n // rows_per_task))
    if rows_to_share:
        wanted = max(wanted, min(n // rows_to_share, df.sparkSession.sparkContext.defaultParallelism))
    return (stored.coalesce(wanted) if wanted < stored.rdd.getNumPartitions() else stored).persist(), n


def scan_headerless_csv(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]], **options) -> DataFrame:
    """CSV without a header row; ``columns`` gives (name, type) in file order."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns)
    return spark.read.options(header=False, **options).schema(schema).csv(path)


def scan_dir(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | str,
    prefix: str = "",
    suffix: str = "",
    fmt: str = "csv",
    recursive: bool = True,
    **options,
) -> DataFrame:
    """Every file below a folder whose name starts and ends as given, as one scan."""
    reader = spark.read.format(fmt).options(**options).option("pathGlobFilter", f"{prefix}*{suffix}")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.schema(schema).load(directory)


def with_file_attrs(df: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Columns parsed out of each row's file path: name -> (regex with one group, type)."""
    path = F.col("_metadata.file_path")
    parsed = [
        F.nullif(F.trim(F.replace(F.regexp_extract(path, rx, 1), F.lit("_"), F.lit(" "))), F.lit(""))
        .cast(kind)
        .alias(name)
        for name, (rx, kind) in fields.items()
    ]
    return df.select("*", *parsed)


# Fixed value: metres per second -> knots.
KNOTS_PER_MS = 1.9438


def with_knots(df: DataFrame, speed: str = "airspeed", out: str = "ktas") -> DataFrame:
    return df.withColumn(out, F.col(speed) * F.lit(KNOTS_PER_MS))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes NULL, so that every missing value is one kind."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def save_stage(df: DataFrame, path: str) -> None:
    """Hand a table to a later job."""
    write_table(df, path)


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    """Store a fitted ML model; any earlier one at the path is replaced."""
    model.write().overwrite().save(path)
