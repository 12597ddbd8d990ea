"""Streaming and inference queries.

The streaming keys run a real Structured Streaming query end to end: the
fixture queue is landed as parquet files under the session's checkpoint
folder (``spark.checkpoint.dir``), read with ``readStream``, processed with
an ``availableNow`` trigger into a checkpointed parquet sink, and the sink
is returned as a batch DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..operators import infer
from ..session import checkpoint_dir
from ..streaming import ledger
from ..streaming.export_stream import start_stream_export
from ..streaming.pack_stream import stream_pack as stream_pack_op
from .q_packing import _PACK_CTES, MAX_BYTES, NOW, STALE_S
from .registry import query

_NOW_MS = 996624000000  # 2001-08-01 00:00:00 UTC, same clock as the batch packer
_FILES_SCHEMA = "bucket string, name string, bytes long, mtime timestamp_ntz"


def _run_dir(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/speechprep/{name}/{uuid.uuid4().hex}"


def _stream_pack_run(t: Tables):
    spark = t.spark
    root = _run_dir(spark, "stream_pack")
    t.v_files.select("bucket", "name", "bytes", "mtime").write.parquet(f"{root}/src")
    arrivals = spark.readStream.schema(_FILES_SCHEMA).parquet(f"{root}/src")
    packed = stream_pack_op(arrivals, MAX_BYTES, STALE_S, now_ms=_NOW_MS)
    q = (packed.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/chk").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(
        "bucket string, name string, bytes long, mtime timestamp_ntz, volume_seq long, reason string"
    ).parquet(f"{root}/out"), root


_H1_SQL = "WITH RECURSIVE " + _PACK_CTES + """
SELECT p.bucket, p.name, p.bytes, p.volume_seq,
       CASE WHEN tail.seq IS NOT NULL AND p.volume_seq = tail.seq THEN 'stale' ELSE 'full' END AS reason
FROM packed p LEFT JOIN tail ON p.bucket = tail.bucket WHERE p.status = 'packed'
"""


@query("stream_pack", ["v_files"], _H1_SQL)
def stream_pack(t: Tables):
    out, _ = _stream_pack_run(t)
    return out.select("bucket", "name", "bytes", "volume_seq", "reason")


@query("stream_export", ["v_files"], "WITH RECURSIVE " + _PACK_CTES + """
SELECT printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq) AS volume_name,
       split_part(printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq), '_', 1) AS lang,
       'volumes/' || split_part(printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq), '_', 1) || '/' ||
         printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq) AS object_key,
       COUNT(*) AS n_files, CAST(SUM(bytes) AS BIGINT) AS bytes
FROM packed WHERE status = 'packed' GROUP BY bucket, volume_seq
""")
def stream_export(t: Tables):
    spark = t.spark
    packed, root = _stream_pack_run(t)
    ts = F.date_format(F.lit(NOW).cast("timestamp_ntz"), "yyyyMMdd_HHmmss")
    manifests = packed.groupBy("bucket", "volume_seq").agg(F.count(F.lit(1)).alias("n_files"),
                                                           F.sum("bytes").alias("bytes"))
    manifests = manifests.select(F.format_string("%s_%s_%03d.tar", F.col("bucket"), ts, F.col("volume_seq")).alias("volume_name"),
                                 "n_files", "bytes")
    manifests.write.parquet(f"{root}/manifests")
    q = start_stream_export(spark, f"{root}/manifests", "volume_name string, n_files long, bytes long",
                            f"{root}/export", f"{root}/export_chk", prefix="volumes/", trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{root}/export").select("volume_name", "lang", "object_key", "n_files", "bytes")


def _flaky(todo):
    """Stand-in transfer: a volume fails as often as its size modulo 5."""
    fails = F.col("attempts") < F.col("bytes") % 5
    return todo.select("volume_name", F.when(fails, F.concat(F.lit("attempt "), (F.col("attempts") + 1).cast("string"))).alias("error"))


@query("export_ledger", ["v_files"], """
SELECT bucket || '_' || name AS volume_name, bytes, CAST(least(bytes % 5 + 1, 3) AS BIGINT) AS attempts,
       CASE WHEN bytes % 5 >= 3 THEN 'parked' ELSE 'done' END AS status, CASE WHEN bytes % 5 >= 3 THEN 'attempt 3' END AS error,
       CASE WHEN bytes % 5 < 3 THEN 'up/' || split_part(bucket || '_' || name, '_', 1) || '/' || bucket || '_' || name END AS object_key
FROM v_files
""")
def export_ledger(t: Tables):
    """Volumes land in four manifests; some fail once, twice or too often."""
    spark, root = t.spark, _run_dir(t.spark, "export_ledger")
    volumes = t.v_files.select(F.concat("bucket", F.lit("_"), "name").alias("volume_name"), F.lit(1).cast("long").alias("n_files"), "bytes")
    volumes.repartition(4).write.parquet(f"{root}/src")
    q = ledger.start_ledger_export(spark, f"{root}/src", "volume_name string, n_files long, bytes long", f"{root}/ledger", f"{root}/chk",
                                   _flaky, trigger={"availableNow": True}, max_files_per_trigger=2)
    q.awaitTermination()
    ledger.retry(spark, f"{root}/ledger", _flaky)
    sent = ledger.exported(spark, f"{root}/ledger", "up/").select("volume_name", "object_key")
    return ledger.ledger(spark, f"{root}/ledger").select("volume_name", "bytes", "attempts", "status", "error").join(sent, "volume_name", "left")


def _words_sql() -> str:
    from ..functions.text import WS_CLASS_RE2
    from .sqlbits import strip_sql

    x = strip_sql("coalesce(d.text, '')")
    return f"""
SELECT a.path,
       CASE WHEN {x} = '' THEN NULL
            ELSE array_to_string(regexp_split_to_array({x}, '{WS_CLASS_RE2}+'), ' ') END AS output,
       CASE WHEN {x} = '' THEN 'ValueError: empty input' END AS error
FROM v_audio a JOIN documents d ON a.doc_id = d.doc_id
"""


@query("batch_infer", ["v_audio"], _words_sql())
def batch_infer(t: Tables):
    clips = t.v_audio.join(t.documents.select("doc_id", "text"), "doc_id").select("path", "text")
    return infer.batch_infer(clips, "path", ["text"], loader=infer.WordsTranscriber,
                             predict=lambda m, b: m(b["text"]), batch_size=256)
