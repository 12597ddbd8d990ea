"""Dealing by cost against its bounds and a plain loop."""

import collections
import random

import pytest

from speechprep.operators import dealing


@pytest.mark.parametrize("seed,n,tasks", [(1, 500, 7), (2, 30, 8), (3, 3, 5), (4, 400, 1)])
def test_loads_differ_by_one_item_at_most(spark, seed, n, tasks):
    rnd = random.Random(seed)
    rows = [(f"c{k}", rnd.choice([None, 0, 5, rnd.randint(1, 60_000), int(rnd.paretovariate(1) * 1000)])) for k in range(n)]
    df = spark.createDataFrame(rows, "path string, d long").repartition(4)
    dealt = dealing.deal_by_cost(df, "path", "d", tasks, 100_000)
    got = dealt.collect()
    assert sorted((r.path, r.d) for r in got) == sorted(rows, key=lambda r: r[0]) and dealt.columns == ["path", "d", "task_no", "batch_no"]
    order = sorted(rows, key=lambda r: (-(r[1] or 0), r[0]))
    where, sums = {}, collections.Counter()
    for k, (path, d) in enumerate(order):
        turn, at = divmod(k, tasks)
        task = at if turn % 2 == 0 else tasks - 1 - at
        where[path] = (task, sums[task] // 100_000)
        sums[task] += d or 0
    assert {r.path: (r.task_no, r.batch_no) for r in got} == where
    load = {r.task_no: r for r in dealing.loads(dealt, "d").collect()}
    longest = max((d or 0 for _, d in rows), default=0)
    every = [load[t].load if t in load else 0 for t in range(tasks)]
    assert max(every) - min(every) <= longest and sum(every) == sum(d or 0 for _, d in rows)
    assert all(r.largest_batch < 100_000 + longest + 1 for r in load.values())


def test_no_items(spark):
    assert dealing.deal_by_cost(spark.createDataFrame([], "path string, d long"), "path", "d", 4, 10).count() == 0
