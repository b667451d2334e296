"""Spark session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this library relies on.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for the LCS kernels: long documents make rows large,
    # so keep batches modest to bound Python worker memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Sizes for a single machine only; a cluster's submit configuration keeps its own.
_LOCAL = {
    # Text scoring is CPU-bound per byte: let AQE coalesce shuffle output only
    # down to small partitions so scoring keeps every core busy.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rubric") -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        for key, value in _LOCAL.items():
            builder = builder.config(key, value)
        builder = builder.config("spark.driver.memory", os.environ.get("RUBRIC_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local tests) a scratch folder is created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="rubric-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Ensure CPU-heavy per-row work (text scoring) uses every core.

    A small file can arrive as a single partition; then rows are spread
    round-robin over the default parallelism.  Inputs that already have at
    least that many partitions (any large scan on a cluster) are returned
    unchanged, so no extra shuffle of the text happens at scale.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # sessions without RDD access: leave the plan as is
        return df
    return df.repartition(target)
