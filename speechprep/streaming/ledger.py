"""Streaming export with a failure ledger (H2).

Every volume has one ledger row: how often it was tried, the last error, and
whether it is done, failed (to be tried again) or parked (tried too often).  Each
micro-batch takes its new volumes and the failed ones, sends them, and merges
the outcomes into the ledger with one idempotent upsert (:mod:`upsert_table`).
The row names the batch that wrote it, so a batch that is run again after a
crash skips what it has already settled, and a volume that is done is never
sent again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upsert_table
from .export_stream import route

SCHEMA = "volume_name string, n_files long, bytes long, attempts long, status string, error string, batch long"
DONE, FAILED, PARKED = "done", "failed", "parked"


def ledger(spark: SparkSession, root: str) -> DataFrame:
    return upsert_table.read(spark, root, SCHEMA)


def exported(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """The volumes that are done, with their routes (A11 layout): each once,
    however often it was tried."""
    return route(ledger(spark, root).where(F.col("status") == DONE).select("volume_name", "n_files", "bytes"), prefix)


def settle(batch: DataFrame, batch_id: int, root: str, send: Callable[[DataFrame], DataFrame], max_attempts: int = 3,
           buckets: int = 16) -> dict:
    """Send a batch's volumes and all failed ones once.

    ``send`` maps rows (volume_name, n_files, bytes, attempts) to rows
    (volume_name, error), null for success; a volume it does not answer for
    counts as failed."""
    spark, columns = batch.sparkSession, ["volume_name", "n_files", "bytes"]
    known = ledger(spark, root)
    fresh = batch.select(*columns).dropDuplicates(["volume_name"]).join(known.select("volume_name"), "volume_name", "left_anti")
    again = known.where((F.col("status") == FAILED) & (F.col("batch") != batch_id)).select(*columns, "attempts")
    todo = fresh.withColumn("attempts", F.lit(0).cast("long")).unionByName(again)
    answers = send(todo).select("volume_name", F.lit(True).alias("_got"), "error")
    tried = todo.join(answers, "volume_name", "left").withColumn("attempts", F.col("attempts") + 1)
    error = F.when(F.col("_got").isNull(), F.lit("no answer")).otherwise(F.col("error"))
    status = F.when(error.isNull(), DONE).when(F.col("attempts") >= max_attempts, PARKED).otherwise(FAILED)
    rows = tried.select(*columns, "attempts", status.alias("status"), error.alias("error"), F.lit(batch_id).cast("long").alias("batch"))
    return upsert_table.upsert(rows, root, "volume_name", buckets)


def start_ledger_export(spark: SparkSession, source_dir: str, schema: str, root: str, checkpoint: str, send, max_attempts: int = 3,
                        trigger: dict | None = None, max_files_per_trigger: int = 16):
    """Export volumes as their manifests land in ``source_dir``."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    write = lambda batch, batch_id: settle(batch, batch_id, root, send, max_attempts) and None
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def retry(spark: SparkSession, root: str, send, max_attempts: int = 3) -> int:
    """Send failed volumes again without waiting for new ones, until each is done
    or parked; returns the rounds.  Rounds have negative batch numbers."""
    rounds = 0
    while ledger(spark, root).where(F.col("status") == FAILED).limit(1).count():
        rounds += 1
        number = min(0, ledger(spark, root).agg(F.min("batch")).first()[0]) - 1
        settle(spark.createDataFrame([], "volume_name string, n_files long, bytes long"), number, root, send, max_attempts)
    return rounds
