"""Session defaults and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is broadcast by hint only after its rows were counted and stay below this.
BROADCAST_ROW_LIMIT = 200_000


def build_session(app_name: str = "factgraph", **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, AQE, ANSI).

    A cluster passes its own master, memory and shuffle sizes through ``conf`` or
    ``spark-submit``; nothing here overrides them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Call sites per column cost several JVM round trips each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is only chosen here when unset and the session is local (tests); a cluster
    session without it is refused, because executors could not read the folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = os.path.join(tempfile.gettempdir(), "factgraph-checkpoints")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` (survives the loss of any executor)."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it again.

    Lineage ends there, as with a checkpoint, and later reads prune columns.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/factgraph-staged/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Hint a broadcast only when ``df`` holds at most ``limit`` rows.

    The count stops after ``limit + 1`` rows. Beyond the limit the plain join stays,
    which Spark shuffles and splits when skewed. Use it on a checkpointed or
    otherwise cheap ``df``.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


# Rows of one task where the work on a row is large.
SPREAD_ROWS = 4000


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """Deal small rows whose further work is large over tasks.

    Spark splits a file by bytes, so a small file of many rows is one task, whatever is made
    of a row later on. The number of tasks follows the counted rows; with few rows there are
    as many tasks as cores. Use it on what is cheap to count and to send, before it grows.
    """
    n = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, -(-n // rows), min(2 * cores, -(-16 * n // rows))))
