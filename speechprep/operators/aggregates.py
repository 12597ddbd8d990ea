"""Aggregations.

All use ``groupBy``/``rollup`` with map-side partial aggregation, so hot
keys are pre-aggregated before the shuffle.  Durations and sizes are summed
as integers (ms, bytes) and divided last, which keeps results exact and
independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from .ordered import ranked


def round_div(name: str, den: int, digits: int = 2) -> Column:
    """``name / den`` rounded half-up to ``digits`` decimals, computed with
    integer division so both engines (and any summation order) agree."""
    scale = 10 ** digits
    return F.expr(f"CAST((({name} * {scale} + {den // 2}) div {den}) AS DOUBLE) / {scale}")


def album_hours(catalog: DataFrame, album: str = "album", duration: str = "duration_ms") -> DataFrame:
    """Hours per album plus a grand-total row.

    ``rollup`` computes both levels from one partial aggregation.  ``is_total``
    is 1 on the grand total only, so files without an album (album NULL) are
    told apart from it."""
    return (
        catalog.rollup(album)
        .agg(F.sum(duration).alias("total_ms"), F.count(duration).alias("n_readable"),
             F.count(F.lit(1)).alias("n_files"), F.grouping(album).cast("int").alias("is_total"))
        .withColumn("hours", round_div("total_ms", 3600000, 2))
    )


def stage_counters(df: DataFrame, unit: str, outcome: str, outcomes: list[str]) -> DataFrame:
    """Per unit, how many rows ended in each outcome plus the total."""
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col(outcome) == F.lit(o)).alias(f"n_{o}") for o in outcomes]
    return df.groupBy(unit).agg(*aggs)


def batch_progress(df: DataFrame, id_col: str, hit: Column, batch_size: int) -> DataFrame:
    """Per id batch ``floor(id / size)``: attempted, hits and the running
    totals of both (D3).  The per-batch table is ~rows/size; the running sum over it uses
    the skew-safe ranked helper instead of a single-partition window."""
    per_batch = (
        df.withColumn("batch_no", F.floor(F.col(id_col) / F.lit(batch_size)).cast("bigint"))
        .groupBy("batch_no")
        .agg(F.count(F.lit(1)).alias("attempted"), F.count_if(hit).alias("hits"))
    )
    out = ranked(per_batch, [], ["batch_no"], value_col="hits", rn_col="_rn", cum_col="cum_hits").drop("_rn")
    out = ranked(out, [], ["batch_no"], value_col="attempted", rn_col="_rn", cum_col="cum_attempted").drop("_rn")
    return out.withColumn("cum_hits", F.col("cum_hits").cast("bigint")) \
        .withColumn("cum_attempted", F.col("cum_attempted").cast("bigint"))


def _ordered_concat(df: DataFrame, key: str, order: str, text: str, slices: int | None) -> DataFrame:
    """``(key, joined)``: ``text`` concatenated in ``order`` per key, built in
    two levels — partial strings per (key, range slice), then the few parts
    per key in slice order — so the per-task collection is bounded by a
    slice even when one key holds a third of all rows.  Only the result
    itself (one value per key) is whole."""
    from .ordered import _num_slices, materialize

    n = _num_slices(df, slices)
    sliced = materialize(df.select(key, order, text).repartitionByRange(n, F.col(key), F.col(order))
                         .withColumn("_slice", F.spark_partition_id()))
    parts = sliced.groupBy(key, "_slice").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text)))),
                                 lambda s: s[text]), "").alias("_part"))
    return parts.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_slice", "_part"))), lambda s: s["_part"]),
                     "").alias("_joined"))


def concat_segments(df: DataFrame, key: str, order: str, text: str, out: str = "text",
                    slices: int | None = None) -> DataFrame:
    """Join a clip's ordered segment texts and strip the ends."""
    return _ordered_concat(df, key, order, text, slices).select(key, strip(F.col("_joined")).alias(out))


def reassemble_chunks(df: DataFrame, key: str = "request_id", arrival: str = "arrival",
                      sequence: str = "sequence", payload: str = "payload", msg_type: str = "msg_type",
                      audio_type: str = "audio", skip_types: tuple[str, ...] = ("frontend",),
                      slices: int | None = None) -> DataFrame:
    """Reassemble a streamed reply.

    Messages are read in arrival order: skipped types are ignored, audio
    payloads are appended until the first audio message with a negative
    sequence (inclusive); any other type before that fails the request.
    Status: ``ok``, ``failed``, ``empty`` (terminal seen, no bytes) or
    ``incomplete`` (no terminal).  The terminal and first failure per
    request are partial aggregates; the payloads are then concatenated in
    two levels (per range slice, then per request), so no task collects more
    than a slice of one reply.
    """
    is_audio = F.col(msg_type) == F.lit(audio_type)
    is_other = ~is_audio & ~F.col(msg_type).isin(*skip_types)
    marks = df.groupBy(key).agg(
        F.min(F.when(is_audio & (F.col(sequence) < 0), F.col(arrival))).alias("_term"),
        F.min(F.when(is_other, F.col(arrival))).alias("_err"),
    )
    failed = F.col("_err").isNotNull() & (F.col("_term").isNull() | (F.col("_err") < F.col("_term")))
    binary = dict(df.dtypes)[payload] == "binary"
    audio = (df.where(is_audio).select(key, arrival, (F.hex(payload) if binary else F.col(payload)).alias("_p"))
             .join(marks, key)
             .where(~failed & (F.col("_term").isNull() | (F.col(arrival) <= F.col("_term")))))
    counts = audio.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    bodies = _ordered_concat(audio.select(key, arrival, "_p"), key, arrival, "_p", slices)
    body = F.coalesce(F.col("_joined"), F.lit(""))
    out = marks.join(bodies, key, "left").join(counts, key, "left")
    return out.select(
        key,
        F.when(failed, F.lit("failed"))
        .when(F.col("_term").isNull(), F.lit("incomplete"))
        .when(F.length(body) == 0, F.lit("empty"))
        .otherwise(F.lit("ok")).alias("status"),
        F.when(failed, F.lit(None)).otherwise(F.unhex(body) if binary else body).alias("audio"),
        F.when(failed, F.lit(0)).otherwise(F.coalesce(F.col("_n"), F.lit(0))).cast("bigint").alias("n_chunks"),
    )
