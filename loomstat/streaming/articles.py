"""Incremental article jobs on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomstat.operators.sentiment import row_sentiment

# Keys already seen are kept on disk rather than in executor memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def article_stream(
    spark: SparkSession, directory: str, schema: str, fmt: str = "parquet", files_per_batch: int = 1000, **options
) -> DataFrame:
    """Files arriving in a folder, as a stream."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return reader.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").load(directory)


def incremental_articles(
    stream: DataFrame,
    out_dir: str,
    checkpoint: str,
    key: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    event_time: str | None = None,
    delay: str = "1 day",
) -> StreamingQuery:
    """Append the articles whose key has not been seen before.

    With an event time the state is bounded: keys older than the delay are
    forgotten and rows later than it are dropped. Without one every key is
    remembered, like the running file this replaces.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = transform(stream) if transform else stream
    if event_time:
        fresh = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))
    else:
        fresh = rows.dropDuplicates(list(key))
    return (
        fresh.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out_dir)
    )


def running_group_sentiment(
    stream: DataFrame, lexicon: Mapping[str, float], group: str, text: str, out_dir: str, checkpoint: str
) -> StreamingQuery:
    """Mean document sentiment per group over everything seen so far.

    Each micro-batch writes the complete table under its own number, so a
    repeated batch overwrites itself instead of counting twice.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    scored = stream.select(F.col(group), row_sentiment(F.col(text), lexicon).alias("r"))
    running = (
        scored.select(group, F.col("r.sentiment").alias("s"), F.col("r.n_words").alias("w"))
        .groupBy(group)
        .agg(F.sum("s").alias("_s"), F.count(F.lit(1)).alias("n_docs"), F.sum("w").alias("n_words"))
        .select(group, (F.col("_s") / F.col("n_docs")).alias("mean_sentiment"), "n_docs", "n_words")
    )

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    return (
        running.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )


def latest_result(spark: SparkSession, out_dir: str) -> DataFrame:
    """The table the last micro-batch wrote."""
    table = spark.read.parquet(out_dir)
    return table.filter(F.col("batch") == table.agg(F.max("batch")).scalar()).drop("batch")
