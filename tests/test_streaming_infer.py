"""H1/H2 over several micro-batches with a restart; I1 failure isolation."""

import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F

from speechprep.operators import infer, packing
from speechprep.streaming.export_stream import start_stream_export
from speechprep.streaming.pack_stream import stream_pack

SCHEMA = "bucket string, name string, bytes long, mtime timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)
NOW_MS = int((T0 + dt.timedelta(hours=10)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def _land(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _run(spark, src, out, chk):
    q = (stream_pack(spark.readStream.schema(SCHEMA).parquet(src), 10, 3600, now_ms=NOW_MS)
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", chk)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def test_stream_pack_restart_no_duplicates(spark, tmp_path):
    src, out, chk = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "chk")
    recent = T0 + dt.timedelta(hours=9, minutes=30)  # not stale at NOW
    _land(spark, [("b", "f1", 4, recent), ("b", "f2", 6, recent + dt.timedelta(seconds=1)),
                  ("b", "f3", 3, recent + dt.timedelta(seconds=2))], src)
    _run(spark, src, out, chk)
    first = {r.name: r.volume_seq for r in spark.read.parquet(out).collect()}
    assert first == {"f1": 0, "f2": 0}  # f3 waits in state
    # restart from the checkpoint with new arrivals
    _land(spark, [("b", "f4", 12, recent + dt.timedelta(seconds=3)), ("b", "f5", 2, T0)], src)
    _run(spark, src, out, chk)
    got = spark.read.parquet(out).collect()
    assert len(got) == len({r.name for r in got})
    seqs = {r.name: (r.volume_seq, r.reason) for r in got}
    # second batch in mtime order: f5 (old) joins f3's open batch -> [3, 2] ... then f4 oversize
    assert seqs["f1"] == (0, "full") and seqs["f2"] == (0, "full")
    assert seqs["f4"][1] == "full" and seqs["f3"][0] == seqs["f5"][0]


def test_stream_single_batch_equals_batch_packer(spark, tmp_path):
    rows = [("k", f"n{i:03d}", (i * 7) % 13 + 1, T0 + dt.timedelta(seconds=i)) for i in range(120)]
    src, out, chk = str(tmp_path / "s"), str(tmp_path / "o"), str(tmp_path / "c")
    _land(spark, rows, src)
    _run(spark, src, out, chk)
    streamed = {r.name: r.volume_seq for r in spark.read.parquet(out).collect()}
    batch = packing.pack_volumes(spark.createDataFrame(rows, SCHEMA), 10, "2024-01-01 10:00:00", 3600, slices=4)
    expected = {r.name: r.volume_seq for r in batch.where("status = 'packed'").collect()}
    assert streamed == expected


def test_stream_packs_files_of_one_millisecond_in_order(spark, tmp_path):
    rows = [("k", f"n{99 - i:02d}", i % 5 + 3, T0 + dt.timedelta(microseconds=7 * i)) for i in range(40)]  # names run against time
    src, out, chk = str(tmp_path / "s"), str(tmp_path / "o"), str(tmp_path / "c")
    _land(spark, rows, src)
    _run(spark, src, out, chk)
    got = spark.read.parquet(out).collect()
    batch = packing.pack_volumes(spark.createDataFrame(rows, SCHEMA), 10, "2024-01-01 10:00:00", 3600, slices=4)
    assert {r.name: r.volume_seq for r in got} == {r.name: r.volume_seq for r in batch.where("status = 'packed'").collect()}
    assert {(r.name, r.mtime) for r in got} == {(n, m) for _, n, _, m in rows}


class _State:
    """What the packer uses of a group's state."""

    exists, hasTimedOut, get = False, False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_stream_packer_holds_one_arrow_batch(spark):
    from speechprep.streaming.pack_stream import _pack_fn

    taken, state = [], _State()

    def arrivals():
        for k in range(50):
            taken.append(k)
            yield pd.DataFrame({"bucket": "b", "name": [f"n{k:02d}{i}" for i in range(4)], "bytes": [3, 4, 5, 6],
                                "mtime": pd.to_datetime([T0 + dt.timedelta(seconds=4 * k + i) for i in range(4)])})

    out, reach = [], []
    for pdf in _pack_fn(10, 3600, NOW_MS)(("b",), arrivals(), state):
        reach.append(len(taken))
        out.append(pdf)
    assert reach[:2] == [1, 2]  # volumes leave before the next batch is read
    got = pd.concat(out)
    batch = packing.pack_volumes(spark.createDataFrame([("b", r.name, r.bytes, r.mtime.to_pydatetime()) for r in got[["name", "bytes", "mtime"]].itertuples(index=False)],
                                                       SCHEMA), 10, "2024-01-01 10:00:00", 3600, slices=4)
    assert dict(zip(got["name"], got["volume_seq"])) == {r.name: r.volume_seq for r in batch.where("status = 'packed'").collect()}
    assert len(got) == 200 and list(state.get[0]) == []


def test_stream_packs_shuffled_arrivals_in_small_arrow_batches(spark, tmp_path):
    rows = [(b, f"n{(i * 37) % 120:03d}", (i * 7) % 13 + 1, T0 + dt.timedelta(seconds=i * 53 % 40)) for i in range(120) for b in ("k", "l", None)]
    src, out, chk = str(tmp_path / "s"), str(tmp_path / "o"), str(tmp_path / "c")
    _land(spark, rows, src)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        _run(spark, src, out, chk)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    batch = packing.pack_volumes(spark.createDataFrame(rows, SCHEMA), 10, "2024-01-01 10:00:00", 3600, slices=4)
    streamed = {(r.bucket, r.name): r.volume_seq for r in spark.read.parquet(out).collect()}
    assert streamed == {(r.bucket, r.name): r.volume_seq for r in batch.where("status = 'packed'").collect()}


def test_stream_export_query_packs_an_arrow_batch_at_a_time(spark, tmp_path, monkeypatch):
    from speechprep.fixtures import Tables
    from speechprep.plans import q_stream
    from speechprep.streaming import pack_stream

    real, log = pack_stream._pack_fn, str(tmp_path / "log")

    def logged(*args):
        fn = real(*args)

        def wrapped(key, pdfs, state):
            taken = []

            def tap():
                for pdf in pdfs:
                    taken.append(len(pdf))
                    yield pdf

            for out in fn(key, tap(), state):
                with open(log, "a") as f:
                    f.write(f"{sum(taken)} {len(out)}\n")
                yield out

        return wrapped

    monkeypatch.setattr(pack_stream, "_pack_fn", logged)
    rows = [(i, "en_1", 400_000.0, T0.replace(year=2001) + dt.timedelta(seconds=i)) for i in range(500)]  # two files fill a volume
    spark.createDataFrame(rows, "o_orderkey long, o_orderpriority string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = q_stream.stream_export(Tables(spark, str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.lang, r.n_files, r.bytes) for r in got) == [("en", 2, 80_000_000)] * 250 and len({r.object_key for r in got}) == 250
    taken, left = 0, 0  # rows the function has read, and rows of volumes it has let go
    with open(log) as f:
        for line in f:
            taken, out = map(int, line.split())
            assert taken - left <= 22  # an Arrow batch and an open volume
            left += out
    assert taken == left == 500


def test_stream_export_idempotent(spark, tmp_path):
    src = str(tmp_path / "m")
    spark.createDataFrame([("en_20240101_000000_000.tar", 3, 10), ("de_20240101_000000_001.tar", 1, 5)],
                          "volume_name string, n_files long, bytes long").write.parquet(src)
    q = start_stream_export(spark, src, "volume_name string, n_files long, bytes long", str(tmp_path / "x"),
                            str(tmp_path / "xc"), prefix="p/", trigger={"availableNow": True})
    q.awaitTermination()
    q = start_stream_export(spark, src, "volume_name string, n_files long, bytes long", str(tmp_path / "x"),
                            str(tmp_path / "xc"), prefix="p/", trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "x")).collect()
    assert sorted((r.lang, r.object_key) for r in got) == [("de", "p/de/de_20240101_000000_001.tar"),
                                                           ("en", "p/en/en_20240101_000000_000.tar")]


def test_batch_infer_isolates_failures(spark):
    df = spark.createDataFrame([("a", "one two"), ("b", ""), ("c", "three")], "path string, text string")
    model = infer.WordsTranscriber()
    got = {r.path: (r.output, r.error is not None) for r in
           infer.batch_infer(df, "path", ["text"], lambda: model, lambda m, b: m(b["text"]), batch_size=8).collect()}
    assert got == {"a": ("one two", False), "b": (None, True), "c": ("three", False)}


def test_live_packer_flushes_stale_leftovers(spark, tmp_path):
    import time

    from speechprep.streaming.pack_stream import start_stream_pack

    src, out, chk = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "chk")
    _land(spark, [("b", f"f{i}", 4, dt.datetime(2020, 1, 1, 0, 0, i)) for i in range(5)], src)
    q = start_stream_pack(spark, src, out, chk, max_bytes=10, stale_seconds=3600, trigger={"processingTime": "1 second"})
    try:
        got = []
        for _ in range(60):  # processing-time timers keep the query alive: poll the sink
            time.sleep(1)
            if os.path.isdir(out):
                got = spark.read.schema(
                    "bucket string, name string, bytes long, mtime timestamp_ntz, volume_seq long, reason string"
                ).parquet(out).collect()
                if len(got) == 5:
                    break
    finally:
        q.stop()
    assert sorted((r.name, r.volume_seq, r.reason) for r in got) == [
        ("f0", 0, "full"), ("f1", 0, "full"), ("f2", 1, "full"), ("f3", 1, "full"), ("f4", 2, "stale")]
