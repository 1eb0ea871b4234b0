"""Streaming candidate admission with keyed state.

State is one row per repository name: when it was first and last seen, and its first
candidate. Spark keeps it in RocksDB and in the query's checkpoint, by a streaming aggregate,
so no row goes through Python. The names of the catalog are a second stream that the first
batch reads whole; a batch then looks up its own names only, so its cost does not grow with
the catalog or with what came before. Rows of one name are combined in every task before the
shuffle, so a name that holds a large share of the candidates sends few rows.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgraph.functions.text import full_name_of_url
from factgraph.operators.intake import catalog_names
from factgraph.session import shared_dir

# Fixed value: Spark's state store on RocksDB, which states of any size need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def admitted_stream(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Streaming frame ``(pos, url, ..., full_name, norm)`` of admitted candidates: the first of
    each strict name that neither ``known`` (a stream of ``norm``) nor an earlier batch holds.
    Candidates without ``pos`` or name are left out.

    Run it in update mode. All rows of a batch have the batch's time, so a name is new when it
    was first seen at the time at which it was last seen; names of the catalog date from 1970.
    """
    own = candidates.columns
    named = candidates.withColumn("norm", F.lower(full_name_of_url(F.col("url")))).filter("norm <> '' AND pos IS NOT NULL")
    seen = named.select("norm", "pos", F.struct(*own).alias("row"), F.current_timestamp().alias("at"))
    old = known.select(
        "norm", F.lit(None).cast(named.schema["pos"].dataType).alias("pos"),
        F.lit(None).cast(seen.schema["row"].dataType).alias("row"), F.timestamp_seconds(F.lit(0)).alias("at"),
    )
    names = seen.unionByName(old).groupBy("norm").agg(
        F.min_by("row", "pos").alias("row"), F.min("at").alias("since"), F.max("at").alias("latest")
    )
    new = names.filter("row IS NOT NULL AND since = latest").select("row.*", "norm")
    return new.select(*own, full_name_of_url(F.col("url")).alias("full_name"), "norm")


def has_begun(spark: SparkSession, folder: str) -> bool:
    """Whether a stream has written its progress to ``folder``."""
    try:
        spark.read.text(f"{folder}/progress/metadata")
    except AnalysisException:
        return False
    return True


def admit_stream(candidates: DataFrame, catalog: DataFrame, folder: str | None = None) -> DataFrame:
    """Drain a stream of candidates into the admitted table and return that table.

    ``candidates`` is a streaming frame ``(pos, url, ...)``. A later call with the same
    ``folder`` goes on where the last one ended: its state and its place in the source lie
    there, and every batch writes a folder of its own, so a batch that runs again after a lost
    executor adds nothing. The catalog of the first call counts; names added to it later are
    not known.
    """
    spark = candidates.sparkSession
    folder = folder or f"{shared_dir(spark)}/admission-{uuid.uuid4().hex}"
    if not has_begun(spark, folder):
        names = catalog_names(catalog).filter("norm <> ''").select("norm").distinct()
        names.write.mode("overwrite").parquet(f"{folder}/catalog")
    known = spark.readStream.schema("norm string").parquet(f"{folder}/catalog")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        rows = admitted_stream(candidates, known)
        query = (
            rows.writeStream.outputMode("update")
            .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/admitted/{n}"))
            .option("checkpointLocation", f"{folder}/progress")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    return spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/admitted")


def candidate_files(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """New candidate files (JSON lines) of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
