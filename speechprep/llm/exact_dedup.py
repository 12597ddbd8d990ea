"""Operator 6: exact deduplication by skew-safe combining.

Texts are normalised (each run of white space becomes one space) and keyed by
their SHA-256.  Copies are combined in three steps, each grouping by digest
*and* full content: inside each input partition (Spark's map-side partial
aggregate), then per (digest, salt, content), then the salt winners per
(digest, content).  Only digests that hold at least 1/256 of all rows are
salted (256 of them at most, by arithmetic), so every text crosses the network
once and a group with a third of all rows reaches no task whole: what moves of
it is one row per input partition.

The text moves once; all else moves as keys.  A key is (digest, length,
xxhash64), so two contents under one digest stay two groups.

Defined cases: null text counts as empty; null doc_ids sort last, so a group
keeps a row without id only if no member has one (keep_id is then null); of
rows that repeat the kept doc_id with the same text exactly one is kept; an
empty table gives an empty result; extra columns are carried by
:func:`filter_docs` and ignored by :func:`groups`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, boxed, hot_keys, lookup, pick, table, unboxed, written


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " ")


def sha(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    content = docs.withColumn("content", normalised(F.col("text"))).drop("text")
    return content.withColumns({
        "digest": digest(F.col("content")),
        "len": F.octet_length("content").cast("long"),
        "mix": F.xxhash64("content"),
    })


_KEY = ["digest", "len", "mix"]


def groups(docs: DataFrame, digest: Callable[[Column], Column] = sha) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    keys = written(
        _keyed(pick(docs, "doc_id", "text"), digest).select(
            "doc_id", *_KEY, F.monotonically_increasing_id().alias("row")
        ),
        "dedup-keys",
    )
    hot = hot_keys(keys.groupBy("digest").agg(F.count("*").alias("n")), "digest", "n", keys.count())

    # local and salted: grouped by content in each partition, then per salt
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    is_hot = F.col("digest").isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(0)
    salted = (
        _keyed(pick(docs, "doc_id", "text"), digest)
        .withColumn("salt", salt)
        .groupBy(*_KEY, "salt", "content")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    winners = written(salted.select(*_KEY, "keep_id", "group_size", F.when(is_hot, F.col("content")).alias("content")),
                      "dedup-salted")
    # the winners of all salts, again by content; a cold group has one salt and is final
    final = (
        winners.where(is_hot)
        .groupBy(*_KEY, "content")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .unionByName(winners.where(~is_hot))
        .drop("content")
    )
    # one row of the kept doc_id stays
    first = (
        keys.groupBy(*_KEY)
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row"))).alias("f"))
        .select(F.struct(*_KEY).alias("k"), F.col("f.row").alias("first_row"))
    )
    final = final.select(F.struct(*_KEY).alias("k"), "keep_id", "group_size").join(first, "k")
    final = final.select(F.col("k.digest").alias("digest"), "k", "keep_id", "group_size", "first_row")
    return _back(keys, final, hot)


def _back(keys: DataFrame, final: DataFrame, hot: list) -> DataFrame:
    rows = keys.select("doc_id", "row", F.struct(*_KEY).alias("k"))
    hot_k = [r[0] for r in final.where(F.col("digest").isin(hot)).select(F.xxhash64("k")).collect()] if hot else []
    out = lookup(
        rows.withColumn("kh", F.xxhash64("k")),
        final.select("k", "keep_id", "group_size", "first_row", F.xxhash64("k").alias("kh")).withColumnRenamed("k", "k2"),
        "kh", hot_k, F.col("row"),
    ).where(F.col("k") == F.col("k2"))
    return out.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("first_row")).alias("kept"), F.col("k.digest").alias("text_sha256"),
    )


def filter_docs(docs: DataFrame, digest: Callable[[Column], Column] = sha) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct content, with
    their columns."""
    marks = written(groups(docs, digest), "dedup-marks")
    kept = marks.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    twice = (
        marks.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
        .select(F.col("doc_id").alias("_id2"), F.col("text_sha256").alias("_sha2"))
    )
    rows = boxed(docs, "doc_id", "text").withColumn("_key", digest(normalised(F.col("text")))).drop("text")
    kept_rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_sha")), "left_semi")
    again = F.col("doc_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_sha2"))
    if twice.isEmpty():
        return unboxed(kept_rows, docs.columns)
    once = kept_rows.join(twice, again, "left_anti")
    first = kept_rows.join(twice, again, "left_semi").groupBy("doc_id", "_key").agg(F.first("_row").alias("_row"))
    return unboxed(once.select("_row").unionByName(first.select("_row")), docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
