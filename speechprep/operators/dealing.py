"""Work dealt by cost (I1, E12): longest first, so that no worker idles.

All items are ranked by cost, longest first, and dealt to tasks in rounds that
run back and forth (0 1 2, 2 1 0, ...).  The first of a round gets the last of
the next, so two tasks' loads never differ by more than the longest item.
Within a task items stay in that order, and batches are cut where the running
cost passes multiples of a bound: batches hold items of near-equal cost, and
none has more than the bound and one item.  Ranks and running sums go through
:func:`ordered.ranked`; nothing is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import ranked


def deal_by_cost(df: DataFrame, key: str, cost: str, tasks: int, batch_cost: int) -> DataFrame:
    """Adds task_no (0 to ``tasks`` - 1) and batch_no (from 0 in each task).
    ``key`` breaks ties; null and negative costs count as 0."""
    weighed = df.withColumn("_cost", F.greatest(F.coalesce(F.col(cost), F.lit(0)), F.lit(0)).cast("bigint"))
    weighed = weighed.withColumn("_less", -F.col("_cost"))
    order = ranked(weighed, [], ["_less", key], rn_col="_rank")
    at, turn = (F.col("_rank") - 1) % tasks, F.floor((F.col("_rank") - 1) / tasks)
    dealt = order.withColumn("task_no", F.when(turn % 2 == 0, at).otherwise(tasks - 1 - at).cast("bigint"))
    summed = ranked(dealt, ["task_no"], ["_less", key], value_col="_cost", rn_col="_k", cum_col="_sum")
    before = F.col("_sum") - F.col("_cost")
    return summed.withColumn("batch_no", F.floor(before / F.lit(batch_cost)).cast("bigint")).drop("_cost", "_less", "_rank", "_k", "_sum")


def loads(dealt: DataFrame, cost: str) -> DataFrame:
    """Per task: items, load, batches, and the largest batch."""
    weight = F.greatest(F.coalesce(F.col(cost), F.lit(0)), F.lit(0))
    per = dealt.groupBy("task_no", "batch_no").agg(F.count("*").alias("n"), F.sum(weight).alias("load"))
    return per.groupBy("task_no").agg(F.sum("n").alias("n_items"), F.sum("load").alias("load"), F.count("*").alias("n_batches"),
                                      F.max("load").alias("largest_batch"))
