"""Packing: fixed cases and the sliced packer against the per-bucket fold."""

import datetime as dt
import random

from pyspark.sql import functions as F

from speechprep.operators import batching, packing

T0 = dt.datetime(2024, 1, 1)


def _files(spark, rows):
    return spark.createDataFrame(rows, "bucket string, name string, bytes long, mtime timestamp_ntz")


def assert_next_fit(sizes, seqs, max_bytes):
    """What defines next-fit, stated on sums: volumes follow one another; a
    volume was below the limit before its last file, fits it or is one file,
    and is either full or could not take the next volume's first file."""
    volumes = {}
    for size, seq in zip(sizes, seqs):
        volumes.setdefault(seq, []).append(size)
    assert list(seqs) == sorted(seqs) and list(volumes) == list(range(len(volumes)))
    for k, v in volumes.items():
        assert sum(v[:-1]) < max_bytes and (sum(v) <= max_bytes or len(v) == 1)
        if k + 1 in volumes:
            assert sum(v) >= max_bytes or sum(v) + volumes[k + 1][0] > max_bytes


def test_pack_fixed_case_and_stale(spark):
    rows = [("b", f"f{i}", s, T0 + dt.timedelta(seconds=i)) for i, s in enumerate([4, 6, 3, 12, 2])]
    df = _files(spark, rows)
    now = "2024-01-01 01:00:04"  # the last file is 3600 s old: stale
    out = packing.pack_volumes(df, 10, now, 3600, slices=3).orderBy("name").collect()
    assert [(r.volume_seq, r.status) for r in out] == [(0, "packed"), (0, "packed"), (1, "packed"), (2, "packed"), (3, "packed")]
    out = packing.pack_volumes(df, 10, "2024-01-01 01:00:03", 3600, slices=3).orderBy("name").collect()
    assert out[-1].status == "waiting" and all(r.status == "packed" for r in out[:-1])


def test_sliced_packer_is_next_fit_in_every_bucket(spark):
    rnd = random.Random(11)
    rows = []
    for b, n in [("hot", 3000), ("a", 7), ("b", 1), ("c", 400)]:
        for i in range(n):
            size = rnd.choice([rnd.randint(1, 30), rnd.randint(1, 200), 100, 250])
            rows.append((b, f"{b}{i:05d}", size, T0 + dt.timedelta(seconds=rnd.randint(0, 10 ** 6))))
    df = _files(spark, rows)
    end = T0 + dt.timedelta(seconds=10 ** 6 + 100)
    results = []
    for slices in (1, 5, 37):
        out = packing.pack_volumes(df, 100, end.strftime("%Y-%m-%d %H:%M:%S"), 500, slices=slices).collect()
        results.append({(r.bucket, r.name): (r.volume_seq, r.status) for r in out})
        for b in ("hot", "a", "b", "c"):
            mine = sorted((r for r in out if r.bucket == b), key=lambda r: (r.mtime, r.name))
            assert_next_fit([r.bytes for r in mine], [r.volume_seq for r in mine], 100)
            last = [r for r in mine if r.volume_seq == mine[-1].volume_seq]
            waits = sum(r.bytes for r in last) < 100 and (end - last[0].mtime).total_seconds() < 500
            assert {r.status for r in last} == {"waiting" if waits else "packed"}
            assert all(r.status == "packed" for r in mine if r.volume_seq != mine[-1].volume_seq)
    assert results[0] == results[1] == results[2]


def test_every_file_once_and_size_bound(spark):
    rnd = random.Random(5)
    rows = [("x", f"n{i:04d}", rnd.randint(1, 60), T0 + dt.timedelta(seconds=i)) for i in range(500)]
    out = packing.pack_volumes(_files(spark, rows), 100, "2030-01-01 00:00:00", 60, slices=9)
    assert out.count() == 500 and out.select("name").distinct().count() == 500
    sizes = out.groupBy("volume_seq").agg(F.sum("bytes").alias("s"), F.count("*").alias("n")).collect()
    assert all(r.s <= 100 or r.n == 1 for r in sizes)


def test_files_without_a_bucket_are_one_bucket(spark):
    rows = [(None if k % 2 else "b", f"n{k:02d}", 30, T0 + dt.timedelta(seconds=k)) for k in range(20)]
    got = packing.pack_volumes(_files(spark, rows), 100, "2030-01-01 00:00:00", 60, slices=4).collect()
    by_bucket = {b: sorted((r.name, r.volume_seq) for r in got if r.bucket == b) for b in (None, "b")}
    assert [len(v) for v in by_bucket.values()] == [10, 10]
    assert [s for _, s in by_bucket[None]] == [s for _, s in by_bucket["b"]]


def test_dedupe_names(spark):
    df = spark.createDataFrame([(1, "a", "x.mp3"), (2, "a", "x.mp3"), (3, "a", "x.mp3"), (4, "b", "x.mp3")],
                               "id long, album string, name string")
    got = {r.id: r.unique_name for r in batching.dedupe_names(df, "album", "name", "id").collect()}
    assert got == {1: "x.mp3", 2: "x_01.mp3", 3: "x_02.mp3", 4: "x.mp3"}


def test_dedupe_names_with_a_chain_of_literal_names(spark):
    names = ["x", "x", "x_01", "x_01_01", "x_01_01_01", "x_01_01_01_01", "x", "x_02", "x", "x_1", "x_01", "x_00", "x_04"]
    df = spark.createDataFrame([(i, "a", n + ".mp3") for i, n in enumerate(names)] + [(99, None, "x.mp3"), (100, None, "x.mp3")],
                               "id long, album string, name string")
    got = {r.id: r.unique_name.removesuffix(".mp3") for r in batching.dedupe_names(df, "album", "name", "id").collect()}
    mine = [got[i] for i in range(len(names))]
    assert len(set(mine)) == len(names) and (got[99], got[100]) == ("x", "x_01")
    # 01, 02 and 04 are literal names: further uses of x get 03, 05, 06; x_01 has 01_01 taken
    assert [mine[i] for i in (1, 6, 8, 10)] == ["x_03", "x_05", "x_06", "x_01_02"]
    assert all(mine[i] == names[i] for i in (0, 2, 3, 4, 5, 7, 9, 11, 12))


def test_dedupe_names_moves_no_long_names_to_count_them(spark, monkeypatch):
    from pyspark.sql import functions as F

    seen, ranked = [], batching.ranked
    monkeypatch.setattr(batching, "ranked", lambda df, *a, **k: ranked(seen.append(df) or df, *a, **k))
    long = "word " * 2000
    names = [long, long, long + "_01", long, ".mp3", "_01.mp3", ".mp3", None, None, "x.y", "x.y"]
    rows = [(None if i in (1, 3) else i // 2, "a", n, i) for i, n in enumerate(names)]  # numbers repeat or are missing
    df = spark.createDataFrame(rows, "id long, album string, name string, row int")
    got = {r.row: r.unique_name for r in batching.dedupe_names(df, "album", "name", "id").collect()}
    assert sorted(got[i] for i in (0, 1, 3)) == [long, long + "_02", long + "_03"] and got[2] == long + "_01"
    assert [got[i] for i in range(4, 11)] == [".mp3", "_01.mp3", ".mp3_01", None, None, "x.y", "x_01.y"]
    widest = [max(d.select(F.greatest(F.lit(0), *[F.length(F.col(c).cast("string")) for c in d.columns]).alias("n")).toPandas()["n"], default=0) for d in seen]
    assert len(seen) == 3 and max(widest) < 100


def test_split_evenly_matches_ntile(spark):
    df = spark.createDataFrame([("a", f"p{i:02d}") for i in range(10)] + [("b", "q1"), ("b", "q2")], "album string, path string")
    got = {r.path: r.part for r in batching.split_evenly(df, "album", "path", 4).collect()}
    assert [got[f"p{i:02d}"] for i in range(10)] == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]
    assert (got["q1"], got["q2"]) == (0, 1)


def test_byte_ranges(spark):
    rows = [("v", f"f{i}", s, T0 + dt.timedelta(seconds=i)) for i, s in enumerate([5, 10, 3])]
    out = batching.volume_byte_ranges(_files(spark, rows), "bucket", ["mtime", "name"], "bytes", 8).orderBy("name", "part_no").collect()
    assert [(r.name, r.offset, r.part_no) for r in out] == [("f0", 0, 0), ("f1", 5, 0), ("f1", 5, 1), ("f2", 15, 1), ("f2", 15, 2)]


def test_sliced_packer_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(sizes=st.lists(st.integers(min_value=1, max_value=40), min_size=1, max_size=120),
           max_bytes=st.integers(min_value=5, max_value=60), slices=st.integers(min_value=1, max_value=9))
    def check(sizes, max_bytes, slices):
        rows = [("q", f"n{i:04d}", s, T0 + dt.timedelta(seconds=i)) for i, s in enumerate(sizes)]
        got = {r.name: r.volume_seq for r in packing.pack_volumes(_files(spark, rows), max_bytes, "2030-01-01 00:00:00",
                                                                   60, slices=slices).collect()}
        assert_next_fit(sizes, [got[f"n{i:04d}"] for i in range(len(sizes))], max_bytes)

    check()
