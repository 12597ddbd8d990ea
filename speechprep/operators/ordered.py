"""Skew-safe ordinals and running sums within groups.

A plain ``Window.partitionBy(group).orderBy(...)`` sends every row of a
group to one task.  If one album / bucket / directory holds a third of all
rows, that task sorts a third of the data.  ``ranked`` instead:

1. range-partitions the rows on ``(group, order)`` – Spark samples the keys
   and cuts the total order into ``slices`` contiguous, equally sized
   ranges, so a hot group is spread over many slices;
2. numbers rows (and sums values, takes lags) inside each
   ``(group, slice)`` with a window – balanced, since a slice is at most
   one range; when only row numbers are needed, the slices are sorted
   before the checkpoint and a row's position is read off its stable id,
   with no window shuffle at all;
3. aggregates per ``(group, slice)`` (at most groups + slices rows) and
   turns those totals into per-slice offsets with a window over that small
   table;
4. joins the offsets back (AQE broadcasts them when small at runtime).

The range-sliced rows are checkpointed once (see :func:`materialize`), so
the slices used for the totals and for the final rows are the same even if
a task is re-run.

Results are exact and deterministic when the order columns are a total
order within the group (callers always pass a unique tie-break).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the cluster's shared ``spark.checkpoint.dir``.

    Slice ids come from ``spark_partition_id()`` after a range shuffle whose
    bounds are sampled at run time; the numbered slices are read twice (per
    slice totals, then the final join), so they are written once and both
    reads see the same slices.  This also cuts the lineage, so chained
    ranked steps do not re-plan (or re-run) their inputs.
    """
    from ..session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _num_slices(df: DataFrame, slices: int | None) -> int:
    if slices:
        return slices
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ranked(df: DataFrame, group_cols: list[str], order_cols: list[str | Column],
           value_col: str | None = None, slices: int | None = None,
           rn_col: str = "rn", cum_col: str = "cum", count_col: str | None = None,
           lag_col: str | None = None, prev_col: str = "prev",
           delta=None, delta_cols: tuple[str, ...] = (), delta_col: str = "dcum") -> DataFrame:
    """Add ``rn_col`` (1-based row number within the group, in order), and if
    ``value_col`` is given ``cum_col`` (inclusive running sum of it); with
    ``count_col`` also the group's row count; with ``lag_col`` also
    ``prev_col``, the previous row's ``lag_col`` in the group (NULL for the
    first row) — across slice boundaries it comes from the previous slice's
    last row.  With ``lag_col`` the order columns must be plain names.

    ``delta`` (needs ``lag_col``) maps the previous row's ``lag_col`` value
    to a number computed on the current row (it may read ``delta_cols``);
    ``delta_col`` is its inclusive running sum — e.g. island ids as a running
    count of "gap before this row is large".  It is resolved in the same
    pass: a slice's first row is evaluated on the small per-slice table."""
    n = _num_slices(df, slices)
    order_exprs = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [F.col(g) for g in group_cols] + order_exprs
    if value_col is None and lag_col is None and delta is None:
        return _ranked_positions(df, group_cols, keys, n, rn_col, count_col)
    sliced = materialize(df.repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id()))
    w = Window.partitionBy(*group_cols, "_slice").orderBy(*order_exprs)
    local = sliced.withColumn("_lrn", F.row_number().over(w))
    aggs = [F.max("_lrn").alias("_cnt")]
    if lag_col is not None:
        local = local.withColumn("_llag", F.lag(lag_col).over(w))
        aggs.append(F.max_by(F.col(lag_col), F.struct(*order_exprs)).alias("_last"))
    if value_col is not None:
        local = local.withColumn(
            "_lcum", F.sum(value_col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        )
        aggs.append(F.sum(value_col).alias("_sum"))
    if delta is not None:
        # rows after the slice's first: delta from the local lag
        local = local.withColumn("_dl", F.when(F.col("_lrn") == 1, F.lit(0)).otherwise(delta(F.col("_llag"))))
        local = local.withColumn("_dlcum", F.sum("_dl").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        aggs.append(F.sum("_dl").alias("_dsum"))
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in delta_cols]), F.struct(*order_exprs)).alias("_frow"))
    totals = local.groupBy(*group_cols, "_slice").agg(*aggs)
    before = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")]
    if value_col is not None:
        offs.append(F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_voff"))
    if count_col is not None:
        offs.append(F.sum("_cnt").over(Window.partitionBy(*group_cols)).alias(count_col))
    if lag_col is not None:
        offs.append(F.lag("_last").over(Window.partitionBy(*group_cols).orderBy("_slice")).alias("_plast"))
    if delta is not None:
        # the first row's delta needs the previous slice's last value
        totals = totals.select("*", F.lag("_last").over(Window.partitionBy(*group_cols).orderBy("_slice")).alias("_pl0"))
        first_row = totals.select(*group_cols, "_slice", "_pl0", "_frow.*")
        first_row = first_row.select(*group_cols, "_slice", delta(F.col("_pl0")).alias("_dfirst"))
        totals = totals.join(first_row, [*group_cols, "_slice"]) if not group_cols else \
            totals.alias("_t").join(first_row.alias("_f"),
                                    [F.col(f"_t.{g}").eqNullSafe(F.col(f"_f.{g}")) for g in group_cols]
                                    + [F.col("_t._slice") == F.col("_f._slice")]).select("_t.*", "_f._dfirst")
        totals = totals.withColumn("_dslice", F.col("_dsum") + F.col("_dfirst"))
        offs.append(F.col("_dfirst"))
        offs.append(F.coalesce(F.sum("_dslice").over(before), F.lit(0)).alias("_doff"))
    offsets = totals.select(*group_cols, "_slice", *offs)
    # null-safe on the group keys: a NULL album is still one group
    cond = [F.col(f"_l.{g}").eqNullSafe(F.col(f"_o.{g}")) for g in group_cols]
    cond.append(F.col("_l._slice") == F.col("_o._slice"))
    extra = [c for c in offsets.columns if c not in group_cols and c != "_slice"]
    out = local.alias("_l").join(offsets.alias("_o"), cond, "inner").select(
        "_l.*", *[F.col(f"_o.{c}") for c in extra]
    )
    out = out.withColumn(rn_col, (F.col("_lrn") + F.col("_off")).cast("bigint"))
    drop = ["_slice", "_lrn", "_off"]
    if value_col is not None:
        out = out.withColumn(cum_col, F.col("_lcum") + F.col("_voff"))
        drop += ["_lcum", "_voff"]
    if lag_col is not None:
        out = out.withColumn(prev_col, F.when(F.col("_lrn") == 1, F.col("_plast")).otherwise(F.col("_llag")))
        drop += ["_llag", "_plast"]
    if delta is not None:
        out = out.withColumn(delta_col, F.col("_doff") + F.col("_dfirst") + F.col("_dlcum"))
        drop += ["_dl", "_dlcum", "_dfirst", "_doff"]
    return out.drop(*drop)


def _ranked_positions(df: DataFrame, group_cols: list[str], keys: list[Column], n: int, rn_col: str,
                      count_col: str | None) -> DataFrame:
    """Row numbers only: no window shuffle at all.  Slices are sorted inside
    before the checkpoint, so a row's position in its slice is its
    ``monotonically_increasing_id`` (stable: both reads below see the same
    checkpointed partition in the same order).  A group's rows in a slice are
    contiguous, so the local rank is the id minus the group's first id in
    that slice; per-slice counts give the offsets."""
    sliced = materialize(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                         .withColumn("_slice", F.spark_partition_id()))
    pos = sliced.withColumn("_mid", F.monotonically_increasing_id())
    totals = pos.groupBy(*group_cols, "_slice").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.col("_m0"), F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")]
    if count_col is not None:
        offs.append(F.sum("_cnt").over(Window.partitionBy(*group_cols)).alias(count_col))
    offsets = totals.select(*group_cols, "_slice", *offs)
    cond = [F.col(f"_l.{g}").eqNullSafe(F.col(f"_o.{g}")) for g in group_cols]
    cond.append(F.col("_l._slice") == F.col("_o._slice"))
    extra = [c for c in offsets.columns if c not in group_cols and c != "_slice"]
    out = pos.alias("_l").join(offsets.alias("_o"), cond, "inner").select(
        "_l.*", *[F.col(f"_o.{c}") for c in extra])
    out = out.withColumn(rn_col, (F.col("_mid") - F.col("_m0") + 1 + F.col("_off")).cast("bigint"))
    return out.drop("_slice", "_mid", "_m0", "_off")
