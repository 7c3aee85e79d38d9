"""Session settings and lineage cutting shared by the whole package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# AQE picks broadcast joins from measured sizes, splits skewed join partitions and sizes shuffles.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python call site costs several JVM calls for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Least partitions of frames that models are fitted on, and the rows from which there are more of them: learners keep up to
# 1 KB for a row (the draws of 100 trees), and a task reads one partition. Keep the number to repeat a fit.
FIT_PARTITIONS = 32
FIT_ROWS = 250_000


def build_session(app_name: str = "starloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of `spark.checkpoint.dir`; where that is unset, one in the warehouse, which is shared too."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured is None:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir')}/stages"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch(spark: SparkSession) -> str:
    """A new folder name below the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/starloom-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame that iterative fits read many times to the shared folder and read it back, cutting its lineage."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_threads(tasks: Sequence[Callable[[], object]], spark: SparkSession, at_once: int | None = None) -> list:
    """Results of calls that run jobs of the session, so many of them (all, if not given) at the same time."""
    at_once = min(at_once or len(tasks), len(tasks))
    if at_once <= 1:
        return [task() for task in tasks]
    with ThreadPool(at_once) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda task: task()), tasks, chunksize=1)


def fit_partitions(n: int) -> int:
    """Partitions of n rows that models are fitted on; they depend on the rows only, not on the cluster."""
    return max(FIT_PARTITIONS, -(-n // FIT_ROWS))


def stored_for_fits(df: DataFrame, key: str, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """A checkpointed frame in a given number of partitions by key, each in order of the key.

    Learners draw per partition, so the same rows must lie in the same partitions whatever the cluster's size or the
    layout of the input. The shuffle is done once; fits read the stored partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartition(partitions, key).sortWithinPartitions(key).checkpoint()
