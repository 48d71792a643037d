"""Session building and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "loomstat", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    AQE coalesces and splits shuffle partitions at run time, so the static
    partition count only has to be large enough for the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh folder under the system
    temporary directory; a cluster session without it is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="loomstat-")
        spark.conf.set("spark.checkpoint.dir", root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, dealt: bool = False, sized: bool = True) -> DataFrame:
    """Replace the plan of an iterated table by its stored rows.

    Stored rows keep the size that the plan was guessed to have. For cogroups that is a product, whose
    digits double in every round; a table that comes from its own last state goes without (not ``sized``).

    ``dealt`` says that the plan ends by dealing rows by a key and that later joins by it should not
    deal them again: Spark knows how stored rows are dealt only where it does not adapt the plan as it runs.
    """
    spark = df.sparkSession
    shared_root(spark)
    if not dealt:
        stored = df.checkpoint(eager=True)
        if sized:
            return stored
        rows = stored._jdf.queryExecution().analyzed().rdd()
        return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, stored._jdf.schema(), False), spark)
    setting = "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        # The plan of a table that was made earlier may be an adaptive one already.
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(setting, before)


def release(df: DataFrame) -> None:
    """Delete the files of a table that came from :func:`cut_lineage`; nothing may read it any more."""
    stored = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if stored.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(stored.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


# Seconds between sweeps, and when the last one was.
SWEEP_EVERY = 5.0
_swept = 0.0


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that no plan reads any more.

    It does so once the driver has collected its garbage, for which rounds on
    tables that stay on the executors give it no reason. Calls close upon each other count as one.
    """
    global _swept
    if time.monotonic() - _swept >= SWEEP_EVERY:
        gc.collect()
        spark._jvm.System.gc()
        _swept = time.monotonic()
