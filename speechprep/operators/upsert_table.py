"""Incremental upsert into a bucketed table.

A table is a folder of bucket directories and numbered versions.  A version is
one small file that names, for each bucket, the directory with its rows; an
upsert rewrites only the buckets that hold new keys (copy on write) and makes
them visible by creating the next version.  That file is created only if it does
not exist yet, so of two writers that start from one version the second is
refused and can start again from what is there then.  Rows of a bucket come
from one read and one write; nothing but the version passes through the driver
(one entry a bucket, whatever the table's size).
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DATA, VERSIONS = "data", "versions"
STALE = 600  # seconds after which a claim without its version counts for nothing


class VersionConflict(RuntimeError):
    """Another writer has made this version meanwhile."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the last version (0 and no buckets at first)."""
    fs, folder = _fs(spark, f"{root}/{VERSIONS}")
    if not fs.exists(folder):
        return 0, {"buckets": {}}
    found = sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
    if not found:
        return 0, {"buckets": {}}
    text = spark.read.option("wholetext", True).text(f"{root}/{VERSIONS}/{found[-1]:012d}.json").first()[0]
    return found[-1], json.loads(text)


def _publish(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Create the version's file with its content, unless there is one."""
    fs, target = _fs(spark, f"{root}/{VERSIONS}/{version:012d}.json")
    claim = _fs(spark, f"{root}/{VERSIONS}/{version:012d}.claim")[1]
    if not fs.exists(target) and fs.exists(claim) and time.time() - fs.getFileStatus(claim).getModificationTime() / 1000 > STALE:
        fs.delete(claim, False)  # its writer died before it could go on
    if fs.exists(target) or not fs.createNewFile(claim):
        raise VersionConflict(f"version {version} of {root} is taken")
    part = _fs(spark, f"{root}/{VERSIONS}/{version:012d}.part")[1]
    out = fs.create(part, True)
    out.write(json.dumps(content).encode())
    out.close()
    if not fs.rename(part, target):
        raise VersionConflict(f"version {version} of {root} can't be written")


def read(spark: SparkSession, root: str, schema: str, version: dict | None = None, only: list[int] | None = None) -> DataFrame:
    """The rows of a version (the last one), or of some of its buckets."""
    content = version or latest(spark, root)[1]
    dirs = [f"{root}/{DATA}/{d}" for b, d in content["buckets"].items() if only is None or int(b) in only]
    return spark.read.schema(schema).parquet(*dirs) if dirs else spark.createDataFrame([], schema)


def _merged(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows of a full join on the key with ``new`` before ``old``, but with
    one shuffle by bucket: a key's new rows stand for its old ones, each once for
    every old row; null keys are all different."""
    both = old.withColumn("_is", F.lit(0)).unionByName(new.select(*old.columns).withColumn("_is", F.lit(1))).repartition("_b")
    same = Window.partitionBy("_b", key)
    both = both.withColumns({"_news": F.sum("_is").over(same), "_olds": F.sum(1 - F.col("_is")).over(same)})
    is_new = F.col(key).isNotNull() & (F.col("_is") == 1)
    kept = both.where(is_new | F.col(key).isNull() | (F.col("_news") == 0))
    times = F.when(is_new, F.greatest(F.lit(1), F.col("_olds").cast("int"))).otherwise(1)
    return kept.withColumn("_each", F.explode(F.sequence(F.lit(1), times))).select(*old.columns)


def upsert(new: DataFrame, root: str, key: str, buckets: int = 64, expect: int | None = None) -> dict:
    """Put ``new`` rows (one a key; new wins) into the table at ``root``.

    Returns version, rewritten (buckets) and changed (rows that differ from
    before).  Nothing is written if no row changes, so an upsert done twice is
    one upsert.  ``expect`` refuses to go on from another version."""
    spark, columns = new.sparkSession, new.columns
    number, content = latest(spark, root)
    if expect is not None and expect != number:
        raise VersionConflict(f"{root} is at version {number}, not {expect}")
    buckets = content.get("n", buckets)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)
    job = uuid.uuid4().hex
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    # staged once: the buckets it touches are counted, then the same rows are merged
    staged = f"{root}/staged/{job}"
    new.withColumn("_b", bucket).write.parquet(staged)
    rows = spark.read.parquet(staged)
    touched = sorted(r[0] for r in rows.select("_b").distinct().collect())  # buckets at most
    old = read(spark, root, schema, content, touched).withColumn("_b", bucket)
    # what changes is found on digests of the texts, each bucket's share is merged in one shuffle
    long = {f.name for f in new.schema.fields if f.dataType.simpleString() in ("string", "binary")}
    rest = [(F.sha2(c, 256) if c in long else F.col(c)).alias(c) for c in columns if c != key]
    side = lambda d, name: d.select("_b", key, F.struct(*rest).alias(name))
    found = side(rows, "_new").join(side(old, "_old"), ["_b", key], "left").where(~F.col("_new").eqNullSafe(F.col("_old")))
    dirty = {r[0]: r[1] for r in found.groupBy("_b").count().collect()}
    if dirty:
        out = _merged(old, rows, key).where(F.col("_b").isin(list(dirty)))
        out.sortWithinPartitions("_b", key).write.partitionBy("_b").parquet(f"{root}/{DATA}/{job}")
        known = {**content["buckets"], **{str(b): f"{job}/_b={b}" for b in dirty}}
        number += 1
        _publish(spark, root, number, {"n": buckets, "key": key, "buckets": known})
    fs, done = _fs(spark, staged)
    fs.delete(done, True)
    return {"version": number, "rewritten": sorted(dirty), "changed": sum(dirty.values())}
