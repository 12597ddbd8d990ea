"""Size-bounded packing of file queues into volumes (E13, A11, F13 names).

Next-fit in mtime order per bucket: before adding a file, an open non-empty
batch that would exceed ``max_bytes`` is closed; after adding, a batch with
``>= max_bytes`` is closed (so an oversize file forms its own volume).  The
last open batch is flushed only when its oldest file is older than
``stale_seconds`` at ``now``; otherwise its files are ``waiting``.

Scale-out: next-fit is a sequential scan, but its batch boundaries only
depend on the files of the batch itself.  The bucket's ordered files are
cut into range slices (a hot bucket spreads over many slices); each slice
resolves, for every possible entry point in its first ``max_bytes`` worth
of files, where the chain of batch starts leaves the slice (chains from
different entries merge after a batch or two, so this summary is tiny);
one small per-bucket pass over the slice summaries fixes the true entry of
every slice; a last parallel pass numbers the batches.  Only
``(name, bytes, mtime)`` ever reach Python, never file contents, and no
task holds more than its own slice plus a ``max_bytes`` halo.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import seconds_between
from ..session import ship_package
from .ordered import materialize


def batch_end(prefix: np.ndarray, i: int, max_bytes: int) -> int:
    """Index of the last file of the batch that starts at file ``i`` (on the
    slice-plus-halo arrays), or -1 when the batch runs past the data."""
    base = prefix[i - 1] if i > 0 else 0
    # first j >= i with S(i, j) >= max
    j = int(np.searchsorted(prefix, base + max_bytes, side="left"))
    if j >= len(prefix):
        return -1
    if j == i:
        return i
    return j if prefix[j] - base == max_bytes else j - 1


# --------------------------------------------------------------------------
# Sliced, skew-safe version
# --------------------------------------------------------------------------
_SENTINEL = 1 << 62


def _ordered_sizes(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    mine = pdf[~pdf["halo"]].sort_values(["mtime", "name"], kind="mergesort")
    extra = pdf[pdf["halo"]].sort_values(["mtime", "name"], kind="mergesort")
    sizes = np.concatenate([mine["bytes"].to_numpy(np.int64), extra["bytes"].to_numpy(np.int64)])
    return mine, sizes


def _slice_exits(max_bytes: int):
    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        mine, sizes = _ordered_sizes(pdf)
        m = len(mine)
        prefix = np.cumsum(sizes)
        # a batch entering from the previous slice ends within our first
        # max_bytes, so the true entry is one of these candidates
        cand_end = min(int(np.searchsorted(prefix, max_bytes, side="left")) + 1, m)
        memo: dict[int, tuple[int, int]] = {}
        res = []
        for c in range(0, cand_end + 1):
            path, p = [], c
            while True:
                if p in memo:
                    ex, cnt = memo[p]
                    break
                if p >= m:
                    ex, cnt = p - m, 0
                    break
                e = batch_end(prefix, p, max_bytes)
                if e < 0:  # open batch running to the end of the bucket
                    ex, cnt = -1, 1
                    memo[p] = (ex, cnt)
                    break
                path.append(p)
                p = e + 1
            for q in reversed(path):
                cnt += 1
                memo[q] = (ex, cnt)
            res.append((c,) + memo.get(c, (ex, cnt)))
        # compress runs of candidates with the same outcome
        rows, lo = [], 0
        for i in range(1, len(res) + 1):
            if i == len(res) or res[i][1:] != res[lo][1:]:
                rows.append((res[lo][0], res[i - 1][0], res[lo][1], res[lo][2]))
                lo = i
        out = pd.DataFrame(rows, columns=["entry_lo", "entry_hi", "exit", "n_batches"])
        out.insert(0, "g", int(pdf["g"].iloc[0]))
        out.insert(0, "bucket", pdf["bucket"].iloc[0])
        return out

    return exits


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per bucket, in group order: the true entry position and the number of
    batches started before each group; and the open tail batch, if any."""
    out, entry, offset, open_end = [], 0, 0, False
    bucket = pdf["bucket"].iloc[0]
    for g, rows in pdf.sort_values(["g", "entry_lo"]).groupby("g", sort=True):
        out.append((bucket, g, entry, offset))
        if entry >= _SENTINEL:
            continue
        hit = rows[(rows["entry_lo"] <= entry) & (rows["entry_hi"] >= entry)]
        if hit.empty:
            raise RuntimeError("pack_volumes: slice entry outside its candidates")
        ex, nb = int(hit["exit"].iloc[0]), int(hit["n_batches"].iloc[0])
        offset += nb
        open_end = ex < 0
        entry = _SENTINEL if ex < 0 else ex
    df = pd.DataFrame(out, columns=["bucket", "g", "entry", "offset"])
    df["tail_seq"] = offset - 1 if open_end else -1
    return df


def _slice_numbers(max_bytes: int):
    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        mine, sizes = _ordered_sizes(pdf)
        prefix = np.cumsum(sizes)
        m = len(mine)
        entry, offset = int(pdf["entry"].iloc[0]), int(pdf["offset"].iloc[0])
        tail_seq = int(pdf["tail_seq"].iloc[0])
        # files before the entry continue the last batch started earlier
        seq = np.full(m, offset - 1, dtype=np.int64)
        p, b = entry, offset - 1
        while p < m:
            e = batch_end(prefix, p, max_bytes)
            b += 1
            last = m - 1 if e < 0 else min(e, m - 1)
            seq[p:last + 1] = b
            if e < 0:
                break
            p = e + 1
        out = mine[["bucket", "name", "bytes", "mtime"]].copy()
        out["volume_seq"] = seq
        out["in_tail"] = seq == tail_seq
        return out

    return number


def _group_slices(max_bytes: int):
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slice")
        gid, acc, ids = 0, 0, []
        for total in pdf["total"].to_numpy(np.int64):
            ids.append(gid)
            acc += int(total)
            if acc >= max_bytes:
                gid, acc = gid + 1, 0
        out = pdf[["bucket", "slice"]].copy()
        out["g"] = np.asarray(ids, dtype=np.int64)
        return out

    return group


def _join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key equals a NULL key (a NULL bucket is one bucket)."""
    same = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    return left.alias("_l").join(right.alias("_r"), same, how).select(
        "_l.*", *[F.col(f"_r.{c}") for c in right.columns if c not in keys])


def pack_volumes(files: DataFrame, max_bytes: int, now: Column | str, stale_seconds: int,
                 bucket: str = "bucket", name: str = "name", size: str = "bytes", mtime: str = "mtime",
                 slices: int | None = None) -> DataFrame:
    """Next-fit volumes per bucket, exact, with no bucket held by one task.

    Output: one row per file ``(bucket, name, bytes, mtime, volume_seq,
    status)`` with ``status`` ``packed`` or ``waiting``.
    """
    spark = files.sparkSession
    ship_package(spark)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    now_lit = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now
    base = files.select(F.col(bucket).alias("bucket"), F.col(name).alias("name"),
                        F.col(size).cast("long").alias("bytes"), F.col(mtime).alias("mtime"))

    # 1. ordered range slices; consecutive slices of a bucket are grouped
    #    until each group holds >= max_bytes (so one group of halo suffices)
    sliced = materialize(base.repartitionByRange(n, "bucket", "mtime", "name")
                         .withColumn("slice", F.spark_partition_id()))
    summary = sliced.groupBy("bucket", "slice").agg(F.sum("bytes").alias("total"))
    groups = summary.groupBy("bucket").applyInPandas(_group_slices(max_bytes), "bucket string, slice int, g long")
    files_g = _join_on(sliced, groups, ["bucket", "slice"]).drop("slice")

    # 2. halo: files of group g+1 within its first max_bytes belong to g too
    w = Window.partitionBy("bucket", "g").orderBy("mtime", "name")
    before = F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, -1))
    halo = (files_g.withColumn("_before", F.coalesce(before, F.lit(0)))
            .where(F.col("_before") < max_bytes).where(F.col("g") > 0)
            .select("bucket", (F.col("g") - 1).alias("g"), "name", "bytes", "mtime", F.lit(True).alias("halo")))
    work = files_g.select("bucket", "g", "name", "bytes", "mtime", F.lit(False).alias("halo")).unionByName(halo)

    # 3. per group: where the batch chain leaves it, for every possible entry
    ranges = work.groupBy("bucket", "g").applyInPandas(
        _slice_exits(max_bytes), "bucket string, g long, entry_lo long, entry_hi long, exit long, n_batches long")
    # 4. per bucket (a few rows per group): true entry and batch offset
    entries = ranges.groupBy("bucket").applyInPandas(
        _chain, "bucket string, g long, entry long, offset long, tail_seq long")
    # 5. per group: number the batches from the true entry
    numbered = _join_on(work, entries, ["bucket", "g"]).groupBy("bucket", "g").applyInPandas(
        _slice_numbers(max_bytes),
        "bucket string, name string, bytes long, mtime timestamp_ntz, volume_seq long, in_tail boolean")

    # the open tail (if any) is the bucket's last batch; it waits unless stale
    age = seconds_between(F.col("mtime"), now_lit)
    oldest = numbered.where("in_tail").groupBy("bucket").agg(F.max(age).alias("_oldest_age"))
    out = _join_on(numbered, oldest, ["bucket"], "left").withColumn(
        "status",
        F.when(F.col("in_tail") & (F.col("_oldest_age") < stale_seconds), F.lit("waiting")).otherwise(F.lit("packed")),
    )
    return out.select("bucket", "name", "bytes", "mtime", "volume_seq", "status")


def volume_manifest(packed: DataFrame, packed_at: str, prefix: str = "") -> DataFrame:
    """One row per packed volume: name ``{bucket}_{ts}_{seq:03d}.tar``,
    files, bytes and its export route ``<prefix><lang>/<name>`` where
    ``lang`` is the name up to the first '_' (A11)."""
    vols = packed.where(F.col("status") == "packed").groupBy("bucket", "volume_seq").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"))
    ts = F.date_format(F.lit(packed_at).cast("timestamp_ntz"), "yyyyMMdd_HHmmss")
    vname = F.format_string("%s_%s_%03d.tar", F.col("bucket"), ts, F.col("volume_seq"))
    lang = F.substring_index(vname, "_", 1)
    return vols.select("bucket", "volume_seq", vname.alias("volume_name"), lang.alias("lang"),
                       F.concat(F.lit(prefix), lang, F.lit("/"), vname).alias("object_key"), "n_files", "bytes")


def write_partitioned_export(manifest: DataFrame, out_dir: str) -> None:
    """Sink for A11: manifests land under ``<out_dir>/lang=<lang>/`` (one
    directory per routed language bucket), idempotent on rerun."""
    manifest.hint("rebalance", "lang").write.mode("overwrite").partitionBy("lang").parquet(out_dir)
