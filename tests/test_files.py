"""The catalog source and the committing sink on scratch trees."""

import os
import subprocess
import sys
import textwrap

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan, StringContains

from speechprep.sources import catalog, files

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CLIPS = "path string, content string"


@pytest.fixture()
def tree(tmp_path):
    for k in range(60):
        d = tmp_path / "data" / f"album{k % 7}" / ("sliced" if k % 2 else ".") / f"d{k % 5}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"c{k}.{['wav', 'mp3', 'txt', 'FLAC'][k % 4]}").write_bytes(b"x" * (10 * k))
    (tmp_path / "data" / "top.wav").write_bytes(b"12345")
    (tmp_path / "data" / "noext").write_bytes(b"")
    return str(tmp_path / "data")


def test_catalog_equals_binary_file(spark, tree):
    for options in ({}, {"partitions": 3}, {"depth": 0}, {"depth": 1, "partitions": 1000}):
        got = {(f"{tree}/{r.path}", r.bytes, r.ext) for r in files.list_files(spark, tree, **options).collect()}
        plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tree)
        want = {(r.path.removeprefix("file:"), r.length, r.ext) for r in plain.select(
            "path", "length", catalog.extension_of(F.col("path")).alias("ext")).collect()}
        # Spark's own file sources leave out empty files
        assert {x for x in got if x[1]} == want and len(got) == 62
    times = {r.path: r.mtime for r in files.list_files(spark, "file://" + tree).collect()}
    assert len(times) == 62 and all(abs(t.timestamp() - os.path.getmtime(f"{tree}/{p}")) < 100_000 for p, t in times.items())
    assert files.list_files(spark, tree + "/absent").count() == 0


def test_catalog_takes_the_filters_it_can_answer(spark, tree):
    df = files.list_files(spark, tree).where("ext IN ('wav', 'mp3') AND bytes >= 100 AND path LIKE '%sliced%'")
    assert sorted(r.path.rsplit("/")[-1] for r in df.collect()) == sorted(
        f"c{k}.mp3" for k in range(60) if k % 4 == 1 and 10 * k >= 100)
    reader = files.CatalogReader({"path": tree})
    left = list(reader.pushFilters([In(("ext",), ("wav",)), GreaterThanOrEqual(("bytes",), 200), LessThan(("bytes",), 400),
                                    StringContains(("path",), "x"), EqualTo(("other",), 1)]))
    assert [type(f).__name__ for f in left] == ["StringContains", "EqualTo"]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert rows and all(r[2] == "wav" and 200 <= r[3] < 400 for r in rows)
    plan = df._jdf.queryExecution().executedPlan().toString()  # what was pushed is not filtered again
    assert "file_catalog" in plan and "sliced" in plan and "100" not in plan and "wav" not in plan


def test_planning_lists_upper_directories_only(tree):
    shallow = files.CatalogReader({"path": tree, "depth": "1"})
    parts = [d for p in shallow.partitions() for d in p.dirs]
    assert (tree, False) in parts and {d for d, deep in parts if deep} == {f"{tree}/album{k}" for k in range(7)}
    listed = [r[0] for p in shallow.partitions() for r in shallow.read(p)]
    assert len(listed) == len(set(listed)) == 62


def test_members_are_published_by_the_commit(spark, tmp_path):
    root = str(tmp_path / "out")
    assert files.members(spark, root).count() == 0
    rows = spark.createDataFrame([(f"a/b{k % 3}/f{k}.txt", "x" * k) for k in range(40)], CLIPS).repartition(5)
    job = files.write_members(rows, root)
    got = {r.path: (r.bytes, r.job) for r in files.members(spark, root).collect()}
    assert got == {f"a/b{k % 3}/f{k}.txt": (k, job) for k in range(40)}
    later = files.write_members(spark.createDataFrame([("a/b0/f0.txt", "changed"), ("new.wav", "é")], CLIPS), root)
    got = {r.path: r for r in files.members(spark, root).collect()}
    assert len(got) == 41 and got["a/b0/f0.txt"].bytes == 7 and got["a/b0/f0.txt"].job == later and got["new.wav"].bytes == 2
    assert open(f"{root}/{got['a/b0/f0.txt'].file}").read() == "changed"
    files.write_members(spark.createDataFrame([], CLIPS), root)
    assert files.members(spark, root).count() == 41


def test_repeated_and_aborted_attempts_are_not_seen(spark, tmp_path):
    root = str(tmp_path / "out")
    batch = lambda *p: iter([pa.record_batch({"path": list(p), "content": ["x"] * len(p)})])
    writer = files.MemberWriter(root, "00000000000000000001-a")
    lost, kept = writer.write(batch("f1", "f2")), writer.write(batch("f1", "f2"))  # the same task, run twice
    other = writer.write(batch("f3"))
    half = files.MemberWriter(root, "00000000000000000002-b")
    half.write(batch("f1"))  # killed before its commit
    failed = files.MemberWriter(root, "00000000000000000003-c")
    failed.abort([failed.write(batch("f9")), None])
    writer.commit([kept, other])
    got = [(r.path, r.file) for r in files.members(spark, root).collect()]
    assert sorted(p for p, _ in got) == ["f1", "f2", "f3"] and not any(lost.attempt in f for _, f in got)
    left = set(os.listdir(f"{root}/members"))
    assert len(left) == 4 and files.vacuum(spark, root, 0) == 2
    assert {kept.attempt, other.attempt} == set(os.listdir(f"{root}/members")) and files.members(spark, root).count() == 3


def test_a_task_that_fails_once_leaves_no_member_twice(tmp_path):
    """A session of its own, as a task is tried again only where failures are allowed."""
    code = f"""
    import os, sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
    from speechprep.sources import files
    flag, root = {str(tmp_path / 'flag')!r}, {str(tmp_path / 'out')!r}
    def once(batches):
        import pandas as pd
        for pdf in batches:
            yield pdf
            if (pdf.path == "f33").any() and not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("lost")
    rows = spark.range(0, 100, 1, 4).selectExpr("'f' || id AS path", "repeat('x', int(id)) AS content").mapInPandas(once, "path string, content string")
    files.write_members(rows, root)
    got = files.members(spark, root).collect()
    attempts = len(os.listdir(root + "/members"))
    print("result", len(got), len(set(r.path for r in got)), sum(r.bytes for r in got), os.path.exists(flag), attempts)
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300)
    line = next((x for x in out.stdout.splitlines() if x.startswith("result")), out.stderr[-2000:])
    assert line.split()[:5] == ["result", "100", "100", "4950", "True"] and int(line.split()[5]) >= 4
