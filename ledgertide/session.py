"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, cpus: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs; on a cluster the submitted configuration wins."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if cpus:
        builder = builder.master(f"local[{cpus}]").config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused directory for a written table or a stream checkpoint.

    On a cluster this lies below the shared folder named by
    ``spark.checkpoint.dir``; only where that is unset (tests, one machine) does
    a local temporary folder serve.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return os.path.join(tempfile.mkdtemp(prefix="ledgertide-"), label)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a scratch table and go on from that (runs a job).

    For a costly intermediate that is read more than once: it is computed once,
    later stages recover from the written files after a lost executor, and its
    size is known to the planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy work on few unsplittable files a task per core.

    Input that already has as many partitions as there are cores, as any large
    log has, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
