"""Operator 8: two-pass external shuffle into shards.

Pass one scatters rows uniformly by a seeded hash into buckets small enough
for one task's memory (their number follows from the total size).  Pass two
gives each task one bucket: the rows are put into a fixed order, shuffled by a
seeded Fisher-Yates permutation and written.  The buckets in sequence are one
uniformly shuffled order of all rows; shard ``s`` of ``n`` is its ``s``-th
stretch, so shard sizes differ by one row at most (law ``rows``).

The same seed and rows give the same order however the input is split.  Rows
that agree in doc_id and text fall together; if such copies are 1/256 or more
of all rows they are scattered by a hash of their row number instead.

Defined cases: null text has size 1 and the CRC of nothing; null doc_ids are
scattered by their text; an empty table gives an empty result; extra columns
travel with their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import boxed, hot_keys, table, written


def _fisher_yates(seed: int):
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        before = pc.max(t.column("before")).as_py()  # of the bucket's one marker row
        t = t.filter(pc.is_null(t.column("before")))
        t = t.take(pc.sort_indices(t, sort_keys=[("h", "ascending"), ("h2", "ascending")]))
        bucket = got[0].column("bucket")[0].as_py()
        order = np.arange(t.num_rows)
        np.random.default_rng([seed, bucket]).shuffle(order)  # Fisher-Yates
        t = t.take(pa.array(order)).append_column("at", pa.array(before + np.arange(t.num_rows), type=pa.int64()))
        yield from t.select(["_row", "at"]).to_batches(max_chunksize=2000)

    return run


def _offsets(bucket_of: DataFrame, block: int = 4096) -> DataFrame:
    """bucket, before: how many rows lie in the buckets ahead of it.  Summed in
    blocks of buckets, so that no task holds more than ``block`` rows or one
    row a block."""
    counts = bucket_of.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("block", F.expr(f"bucket div {block}"))
    ahead = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = counts.select("bucket", "block", ahead(Window.partitionBy("block").orderBy("bucket")).alias("inside"))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n")).select("block", ahead(Window.orderBy("block")).alias("base"))
    return inside.join(blocks, "block").select("bucket", (F.col("base") + F.col("inside")).alias("before"))


def shuffle(docs: DataFrame, shards: int = 16, seed: int = 17, bucket_bytes: int = 32 << 20) -> DataFrame:
    """``row`` (struct of all input columns), shard and slot, in shuffled order.

    The rows of a bucket are counted on a scan of their own, which moves no
    text; each bucket's task gets the number of rows ahead of it as a marker
    row, so the texts cross one exchange and are placed where they arrive."""
    spark = docs.sparkSession
    ship_package(spark)
    hashed = {
        "h": F.xxhash64(F.lit(seed), "doc_id", "text"), "h2": F.xxhash64("text", "doc_id", F.lit(~seed)),
        "size": F.coalesce(F.octet_length("text"), F.lit(0)) + 1,
    }
    d = boxed(docs, "doc_id", "text").withColumns(hashed)
    n, size = d.agg(F.count("*"), F.sum(F.col("size").cast("long"))).first()
    buckets = max(1, -(-(size or 0) // bucket_bytes))
    hot = hot_keys(d.groupBy("h").agg(F.count("*").alias("n")), "h", "n", n) if n else []
    key: Column = F.col("h")
    if hot:
        # written first: both scans below must see the same row under the same number
        d = written(d, "shuffle-rows").withColumn("_n", F.monotonically_increasing_id())
        key = F.when(key.isin(hot), F.xxhash64(F.lit(seed), "_n")).otherwise(key)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    none = F.lit(None)
    scattered = d.select("_row", "h", "h2", bucket, none.cast("long").alias("before"))
    markers = _offsets(d.select(bucket)).select(
        none.cast(d.schema["_row"].dataType).alias("_row"), none.cast("long").alias("h"), none.cast("long").alias("h2"), "bucket", "before")
    placed = scattered.unionByName(markers).repartitionById(buckets, F.col("bucket"))
    schema = f"_row {d.schema['_row'].dataType.simpleString()}, at long"
    at = placed.mapInArrow(_fisher_yates(seed), schema)
    at = at.withColumn("shard", F.expr(f"CAST((at * {shards}) div {max(1, n)} AS INT)"))
    first = F.expr(f"(CAST(shard AS LONG) * {max(1, n)} + {shards - 1}) div {shards}")
    fields = [F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return at.select(F.struct(*fields).alias("row"), "shard", (F.col("at") - first).alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """The shards as folders ``shard=0 ...`` of Parquet files, rows in slot order
    inside each file."""
    shuffled.select("row.*", "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    out = shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
