"""Batches, even splits, byte ranges, unique names, top-N, ages
(E11, E12, E14, E15, E16, E17).

Per-group ordinals go through :func:`ordered.ranked`, which spreads a hot
group over many range slices instead of one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import splitext
from .ordered import materialize, ranked


def assign_batches(df: DataFrame, group: str, order: str, size: int, out: str = "batch_no") -> DataFrame:
    """Consecutive fixed-size batches per group in ``order`` (E11):
    ``batch = (row_number - 1) div size``."""
    r = ranked(df, [group], [order], rn_col="_rn")
    return r.withColumn(out, F.floor((F.col("_rn") - 1) / F.lit(size)).cast("bigint")).drop("_rn")


def split_evenly(df: DataFrame, group: str, order: str, n: int, out: str = "part") -> DataFrame:
    """Contiguous near-equal parts, the first ``count % n`` one longer (E12);
    same rule as SQL ``ntile(n) - 1``, computed from row number and group size."""
    r = ranked(df, [group], [order], rn_col="_rn", count_col="_cnt")
    base = F.floor(F.col("_cnt") / F.lit(n))
    rem = F.col("_cnt") - base * F.lit(n)
    big = rem * (base + 1)
    part = F.when(F.col("_rn") <= big, F.floor((F.col("_rn") - 1) / (base + 1))).otherwise(
        rem + F.floor((F.col("_rn") - 1 - big) / base)
    )
    return r.withColumn(out, part.cast("bigint")).drop("_rn", "_cnt")


def volume_byte_ranges(df: DataFrame, group: str, order: list[str], size_col: str, part_bytes: int) -> DataFrame:
    """Cut each group's concatenated archive into fixed ``part_bytes`` parts
    and list the parts every file touches (E14).  Offsets are a skew-safe
    running sum; the explode is bounded by the file's own size / part size."""
    r = ranked(df, [group], list(order), value_col=size_col, rn_col="_rn", cum_col="_end")
    start = F.col("_end") - F.col(size_col)
    first = F.floor(start / F.lit(part_bytes)).cast("bigint")
    last = F.floor(F.greatest(F.col("_end") - 1, start) / F.lit(part_bytes)).cast("bigint")
    return (
        r.withColumn("offset", start.cast("bigint"))
        .withColumn("first_part", first)
        .withColumn("last_part", last)
        .withColumn("part_no", F.explode(F.sequence(first, last)))
        .drop("_rn", "_end")
    )


def dedupe_names(df: DataFrame, group: str, name: str, order: str, width: int = 2, out: str = "unique_name") -> DataFrame:
    """Make names unique per group (E15): the first use of a name keeps it, the
    k-th further one gets the k-th suffix ``_01``, ``_02`` ... (``width`` digits;
    0 = no padding, before the extension) that no literal name of the group has.

    One pass, exact for any chain of literal names: a free suffix is its
    ordinal plus the taken ones below it, and those are counted by a running
    sum over taken and wanted suffixes together.  A generated name never meets
    another one, as its last number gives back its root.

    Names may be long: they are written once with a row number and shuffled once,
    when the suffixes are joined; all counting is done on SHA-256 digests.
    """
    key = [group, "_key"]
    sfx = lambda n: F.format_string(f"%0{width}d" if width > 0 else "%d", n)
    # a name is told by the digest of its root and extension
    digest = lambda root, ext: F.unhex(F.sha2(F.concat(F.length(root).cast("string"), F.lit(":"), root, ext), 256))
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    root, ext = splitext(F.col(name))
    parts = rows.select(F.col(group), F.col(order).alias("_order"), "_row", root.alias("_root"), ext.alias("_ext"))
    parts = parts.withColumn("_digits", F.regexp_extract("_root", "_([0-9]{1,18})$", 1))
    number = F.when(F.col("_digits") != "", F.col("_digits").cast("bigint"))
    parts = parts.withColumn("_t", F.when((number > 0) & (F.col("_digits") == sfx(number)), number))
    stem = F.when(F.col("_t").isNotNull(), digest(F.regexp_replace("_root", "_[0-9]+$", ""), F.col("_ext")))
    keys = parts.select(group, "_order", "_row", digest(F.col("_root"), F.col("_ext")).alias("_key"), "_t", stem.alias("_stem"))
    r = ranked(keys, key, ["_order", "_row"], rn_col="_rn")
    taken = r.where("_rn = 1 AND _t IS NOT NULL").select(group, F.col("_stem").alias("_key"), "_t")
    # a taken suffix t stands behind t - i free ones, i being its rank among the taken
    taken = ranked(taken, key, ["_t"], rn_col="_i").select(*key, (F.col("_t") - F.col("_i")).alias("_at"), F.lit(1).alias("_w"))
    wanted = r.where("_rn > 1").select(*key, "_row", (F.col("_rn") - 1).cast("bigint").alias("_at"), F.lit(0).alias("_w"))
    both = wanted.unionByName(taken, allowMissingColumns=True)
    placed = ranked(both, key, ["_at", "_w"], value_col="_w", rn_col="_k", cum_col="_below").where("_w = 0")
    numbers = placed.select("_row", (F.col("_at") + F.col("_below")).cast("bigint").alias("_n"))
    unique = F.when(F.col("_n").isNull(), F.col(name)).otherwise(F.concat(root, F.lit("_"), sfx(F.col("_n")), ext))
    return rows.join(numbers, "_row", "left").withColumn(out, unique).select(*df.columns, out)


def latest_n(df: DataFrame, group: str, order: list[Column], n: int, out: str = "rank") -> DataFrame:
    """Top ``n`` rows per group (E16).  ``row_number() <= n`` lets Spark plan
    a partial WindowGroupLimit before the shuffle, so at most n rows per
    group and map task cross the network even for a hot group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def oldest_wait(df: DataFrame, group: str, mtime: str, now: Column, stale_seconds: int,
                out: str = "minutes_left") -> DataFrame:
    """Minutes before a bucket's leftovers are force-flushed (E17); ``df`` holds
    the files that packing left waiting: ``max(0, stale - (now - min(mtime)))``.  ``now`` is a parameter so the
    result is reproducible."""
    oldest = df.groupBy(group).agg(F.min(mtime).alias("oldest_mtime"), F.count(F.lit(1)).alias("n_files"))
    from ..functions.times import seconds_between

    age_s = seconds_between(F.col("oldest_mtime"), now)
    left = F.greatest(F.lit(0), F.lit(stale_seconds) - age_s)
    return oldest.withColumn("age_s", age_s.cast("bigint")).withColumn(out, (left / F.lit(60.0)).cast("double"))
