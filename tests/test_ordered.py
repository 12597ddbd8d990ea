"""The skew-safe ranked helper against plain windows, with a hot group."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from speechprep.operators.ordered import ranked


def test_ranked_matches_windows_under_skew(spark):
    rnd = random.Random(2)
    rows = [("hot", i, rnd.randint(0, 9)) for i in range(5000)]
    rows += [(f"g{k}", i, rnd.randint(0, 9)) for k in range(50) for i in range(rnd.randint(1, 20))]
    rows += [(None, i, 1) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = ranked(df, ["g"], ["o"], value_col="v", slices=13, rn_col="rn", cum_col="cum",
                 count_col="cnt", lag_col="o", prev_col="prev")
    got = ranked(got.withColumn("one", F.lit(1)), ["g"], ["o"], value_col="one", slices=7, rn_col="rn2", cum_col="cum2")
    w = Window.partitionBy("g").orderBy("o")
    ref = df.select("g", "o", F.row_number().over(w).alias("rn_r"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_r"),
                    F.count("*").over(Window.partitionBy("g")).alias("cnt_r"),
                    F.lag("o").over(w).alias("prev_r"))
    j = got.join(ref, [got.g.eqNullSafe(ref.g), got.o == ref.o])
    assert j.count() == len(rows)
    bad = j.where((F.col("rn") != F.col("rn_r")) | (F.col("cum") != F.col("cum_r")) | (F.col("cnt") != F.col("cnt_r"))
                  | ~F.col("prev").eqNullSafe(F.col("prev_r")) | (F.col("rn2") != F.col("rn_r")) | (F.col("cum2") != F.col("rn_r")))
    assert bad.count() == 0


def test_ranked_delta_islands(spark):
    rnd = random.Random(4)
    rows, expected = [], {}
    for g in ["hot"] * 1 + [f"c{k}" for k in range(20)]:
        n = 3000 if g == "hot" else rnd.randint(1, 40)
        pos = sorted(rnd.sample(range(n * 4), n))
        isl, prev = 0, None
        for p in pos:
            if prev is None or p - prev > 3:
                isl += 1
            rows.append((g, p))
            expected[(g, p)] = isl
            prev = p
    df = spark.createDataFrame(rows, "g string, o long")
    got = ranked(df, ["g"], ["o"], slices=11, lag_col="o", prev_col="p",
                 delta=lambda prev: F.when(prev.isNull() | (F.col("o") - prev > 3), 1).otherwise(0),
                 delta_cols=("o",), delta_col="isl")
    assert {(r.g, r.o): r.isl for r in got.collect()} == expected


def test_ranked_positions_fast_path(spark):
    rnd = random.Random(8)
    rows = [("hot", rnd.random(), i) for i in range(4000)] + [(f"k{j}", rnd.random(), j) for j in range(300)]
    rows += [(None, rnd.random(), i) for i in range(17)]
    df = spark.createDataFrame(rows, "g string, o double, tie long")
    got = ranked(df, ["g"], [F.col("o").desc(), "tie"], slices=9, rn_col="rn", count_col="cnt")
    w = Window.partitionBy("g").orderBy(F.col("o").desc(), "tie")
    ref = df.select("g", "o", "tie", F.row_number().over(w).alias("rn_r"), F.count("*").over(Window.partitionBy("g")).alias("cnt_r"))
    j = got.join(ref, [got.g.eqNullSafe(ref.g), got.o == ref.o, got.tie == ref.tie])
    assert j.count() == len(rows)
    assert j.where((F.col("rn") != F.col("rn_r")) | (F.col("cnt") != F.col("cnt_r"))).count() == 0
