"""Streaming volume packer (H1).

Files arriving in bucket directories are a stream ``(bucket, name, bytes,
mtime)``.  Per bucket, a stateful operator keeps only the *open* batch
(bounded by ``max_bytes``) and the next volume sequence number; every
micro-batch runs next-fit over the arrivals (mtime order) on top of the
open batch, emits the volumes that filled up, and flushes the open batch
once its oldest file is ``stale_seconds`` old.  Spark sorts the arrivals, and
they pass through Python an Arrow batch at a time, so memory there does not grow
with the micro-batch.  A processing-time timeout
flushes idle buckets too, so leftovers never wait for new arrivals.

Times are kept in microseconds, as the input has them.  State lives in the checkpointed state store (RocksDB provider), so a
restarted query neither loses an open batch nor re-emits a closed volume.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT_SCHEMA = ("bucket string, name string, bytes long, mtime timestamp_ntz, volume_seq long, "
                 "reason string")
STATE_SCHEMA = "names array<string>, sizes array<long>, mtimes array<long>, next_seq long"


def _next_fit(sizes: list[int], start: int, max_bytes: int) -> list[int]:
    """Where volumes end (index behind the last file).  The first ``start``
    files are an open batch, which is known to fit."""
    ends, first, held = [], 0, sum(sizes[:start])
    for i in range(start, len(sizes)):
        if i > first and held + sizes[i] > max_bytes:
            ends.append(i)
            first, held = i, 0
        held += sizes[i]
        if held >= max_bytes:
            ends.append(i + 1)
            first, held = i + 1, 0
    return ends


def _pack_fn(max_bytes: int, stale_seconds: int, now_ms: int | None):
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, sizes, mtimes, seq = state.get if state.exists else ([], [], [], 0)
        names, sizes, mtimes = list(names), [int(x) for x in sizes], [int(x) for x in mtimes]
        now = now_ms if now_ms is not None else state.getCurrentProcessingTimeMs()

        def closed(counts: list[int], reason: str) -> pd.DataFrame:
            """The first files of the open batch as volumes of so many files."""
            n = sum(counts)
            return pd.DataFrame({"bucket": pd.Series([key[0]] * n, dtype=object), "name": pd.Series(names[:n], dtype=object), "bytes": sizes[:n],
                                 "mtime": pd.to_datetime(np.array(mtimes[:n], dtype=np.int64), unit="us"),
                                 "volume_seq": seq + np.repeat(np.arange(len(counts)), counts), "reason": reason})

        if not state.hasTimedOut:
            # the arrivals come in order, an Arrow batch at a time; no more
            # than one of them and the open batch is held
            last = None
            for arrivals in pdfs:
                if not len(arrivals):
                    continue
                us = arrivals["mtime"].astype("datetime64[us]").astype(np.int64).to_numpy()
                if (us[1:] < us[:-1]).any() or (last is not None and us[0] < last):
                    raise RuntimeError("stream_pack: arrivals are not in mtime order")
                last, start = us[-1], len(names)
                names += arrivals["name"].tolist()
                sizes += arrivals["bytes"].astype(np.int64).tolist()
                mtimes += us.tolist()
                ends = _next_fit(sizes, start, max_bytes)
                if ends:
                    yield closed(np.diff([0, *ends]).tolist(), "full")
                    names, sizes, mtimes = names[ends[-1]:], sizes[ends[-1]:], mtimes[ends[-1]:]
                    seq += len(ends)
        # leftovers: flush when the oldest file is stale
        if names and now * 1000 - min(mtimes) >= stale_seconds * 1_000_000:
            yield closed([len(names)], "stale")
            names, sizes, mtimes = [], [], []
            seq += 1
        state.update((names, sizes, mtimes, seq))
        if names and now_ms is None:
            wait_ms = max(1, stale_seconds * 1000 - (now - min(mtimes) // 1000))
            state.setTimeoutDuration(int(wait_ms))

    return fn


def stream_pack(arrivals: DataFrame, max_bytes: int, stale_seconds: int, now_ms: int | None = None) -> DataFrame:
    """Stateful per-bucket packing of a streaming file queue (H1).

    ``arrivals`` is a streaming DataFrame ``(bucket, name, bytes, mtime)``.
    Output (append mode): one row per file of every closed volume with its
    per-bucket ``volume_seq`` and the closing ``reason`` (``full`` or
    ``stale``).  ``now_ms`` pins the clock (reproducible runs); by default
    the processing time is used.
    """
    # With a pinned clock nothing can become stale between batches, so no
    # timer is armed (timers would also keep an availableNow run alive).
    from ..session import ship_package

    spark = arrivals.sparkSession
    ship_package(spark)
    # Spark sorts a bucket's arrivals of a micro-batch (spilling if it must), so
    # the function holds one Arrow batch of them.  The check of streaming plans
    # knows no sort within partitions and refuses it, so it is off in this session.
    spark.conf.set("spark.sql.streaming.unsupportedOperationCheck", "false")
    arrivals = arrivals.repartition("bucket").sortWithinPartitions("bucket", "mtime", F.col("name").asc_nulls_last(), "bytes")
    timeout = GroupStateTimeout.NoTimeout if now_ms is not None else GroupStateTimeout.ProcessingTimeTimeout
    return arrivals.groupBy("bucket").applyInPandasWithState(
        _pack_fn(max_bytes, stale_seconds, now_ms), OUTPUT_SCHEMA, STATE_SCHEMA, "append", timeout,
    )


def start_stream_pack(spark, source_dir: str, out_dir: str, checkpoint: str, max_bytes: int = 1 << 30,
                      stale_seconds: int = 3600, trigger: dict | None = None, max_files_per_trigger: int = 10_000):
    """Run the packer as a service: watch ``source_dir`` (file-queue
    manifests ``(bucket, name, bytes, mtime)`` as parquet), poll every 10 s by
    default, append closed volumes to ``out_dir``.  ``maxFilesPerTrigger``
    bounds each micro-batch."""
    arrivals = (spark.readStream.schema("bucket string, name string, bytes long, mtime timestamp_ntz")
                .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    return (stream_pack(arrivals, max_bytes, stale_seconds)
            .writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"processingTime": "10 seconds"})).start())
