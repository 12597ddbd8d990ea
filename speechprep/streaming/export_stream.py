"""Streaming export of finished volumes (H2).

Finished volume manifests land as files; a file-source stream picks each up
exactly once (the checkpoint records which files were consumed — the
"in-flight set"), and ``foreachBatch`` writes the routed manifest rows under
``<out>/lang=<lang>/`` (A11 layout).  Each batch writes to its own
``batch=<id>`` directory with overwrite semantics, so a batch retried after
a failure replaces its own partial output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route(volumes: DataFrame, prefix: str = "") -> DataFrame:
    """Object key ``<prefix><lang>/<volume_name>``; lang = name up to '_'."""
    lang = F.substring_index(F.col("volume_name"), "_", 1)
    return volumes.withColumn("lang", lang).withColumn(
        "object_key", F.concat(F.lit(prefix), F.col("lang"), F.lit("/"), F.col("volume_name")))


def export_batch_writer(out_dir: str, prefix: str = ""):
    """``foreachBatch`` function: idempotent per batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = route(batch, prefix)
        (routed.hint("rebalance", "lang").write.mode("overwrite")
         .partitionBy("lang").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}"))

    return write


def start_stream_export(spark, source_dir: str, schema: str, out_dir: str, checkpoint: str, prefix: str = "",
                        trigger: dict | None = None):
    """Start the export stream over manifest files in ``source_dir``."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(export_batch_writer(out_dir, prefix)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return writer.start()
