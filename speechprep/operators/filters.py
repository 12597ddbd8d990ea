"""Duration filters, pruning verdicts, skip-done and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_duration_range(df: DataFrame, min_ms: int = 0, max_ms: int | None = None,
                          col: str = "duration_ms") -> DataFrame:
    """Keep ``min_ms <= d`` and (no max or ``d <= max_ms``); NULL (unreadable)
    durations are dropped (B1).  A plain predicate: pushed into the scan when
    the catalog is stored as parquet."""
    cond = F.col(col) >= F.lit(min_ms)
    if max_ms is not None:
        cond = cond & (F.col(col) <= F.lit(max_ms))
    return df.where(cond)


def prune_clips(df: DataFrame, min_ms: int = 5000, max_ms: int = 45000,
                col: str = "duration_ms") -> DataFrame:
    """Verdict per clip (B2): ``short`` (< min), ``long`` (> max), ``keep``;
    unreadable (NULL) clips are kept with verdict ``unreadable``.  Nothing is
    deleted: callers act on ``keep``."""
    d = F.col(col)
    verdict = (
        F.when(d.isNull(), F.lit("unreadable"))
        .when(d < F.lit(min_ms), F.lit("short"))
        .when(d > F.lit(max_ms), F.lit("long"))
        .otherwise(F.lit("keep"))
    )
    return df.withColumn("verdict", verdict).withColumn("keep", ~F.col("verdict").isin("short", "long"))


def skip_processed(df: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Drop inputs whose key already has a result (B3): a left-anti join.
    Only the key column of ``done`` is read; AQE turns it into a broadcast
    hash join when the done-set is small at runtime, a shuffled join
    otherwise."""
    return df.join(done.select(key), on=key, how="left_anti")


def route_by_duration(df: DataFrame, split_ms: int = 30000, failed_short: DataFrame | None = None,
                      col: str = "duration_ms", key: str = "path") -> DataFrame:
    """Two-pass routing.

    Pass 1 (``short``) takes ``d <= split``; pass 2 (``long``) takes
    ``d >= split`` not already transcribed by pass 1, so a clip of exactly
    ``split`` goes long only when pass 1 failed on it (``failed_short``
    holds the keys pass 1 left without a result).  NULL → ``unreadable``.
    """
    d = F.col(col)
    out = df
    retry = F.lit(False)
    if failed_short is not None:
        flagged = failed_short.select(key).distinct().withColumn("_failed", F.lit(True))
        out = out.join(flagged, on=key, how="left")
        retry = F.coalesce(F.col("_failed"), F.lit(False)) & (d == F.lit(split_ms))
    route = (
        F.when(d.isNull(), F.lit("unreadable"))
        .when(retry, F.lit("long"))
        .when(d <= F.lit(split_ms), F.lit("short"))
        .otherwise(F.lit("long"))
    )
    out = out.withColumn("route", route).withColumn(
        "pass_no", F.when(F.col("route") == "short", F.lit(1)).when(F.col("route") == "long", F.lit(2))
    )
    return out.drop("_failed") if failed_short is not None else out
