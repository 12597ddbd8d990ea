"""Incremental upsert: only touched buckets are rewritten, one version at a time."""

import os
import random

import pytest

from speechprep.operators import upsert_table as table

ROWS = "path string, text string"


def rows_of(spark, root):
    return {r.path: r.text for r in table.read(spark, root, ROWS).collect()}


def test_upserts_equal_a_dictionary(spark, tmp_path):
    root, rnd, want = str(tmp_path / "t"), random.Random(1), {}
    assert table.latest(spark, root) == (0, {"buckets": {}}) and rows_of(spark, root) == {}
    for step in range(5):
        new = {f"p{rnd.randrange(60)}": rnd.choice([None, "x", f"text {step}"]) for _ in range(25)}
        got = table.upsert(spark.createDataFrame(sorted(new.items(), key=str), ROWS).repartition(3), root, "path", buckets=8)
        changed = sum(k not in want or want[k] != v for k, v in new.items())
        want |= new
        assert rows_of(spark, root) == want and got["changed"] == changed and got["version"] == step + 1
    again = table.upsert(spark.createDataFrame(sorted(new.items(), key=str), ROWS), root, "path")
    assert again == {"version": 5, "rewritten": [], "changed": 0}  # done twice is done once
    assert table.upsert(spark.createDataFrame([], ROWS), root, "path")["version"] == 5
    assert not os.listdir(f"{root}/staged")


def test_only_the_buckets_of_changed_keys_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    first = table.upsert(spark.createDataFrame([(f"p{k}", "a") for k in range(400)], ROWS), root, "path", buckets=16)
    assert first["rewritten"] == list(range(16))
    before = table.latest(spark, root)[1]["buckets"]
    second = table.upsert(spark.createDataFrame([("p7", "b"), ("p8", "a")], ROWS), root, "path")
    after = table.latest(spark, root)[1]["buckets"]
    assert len(second["rewritten"]) == 1 and second["changed"] == 1  # p8 is as before
    assert [b for b in after if after[b] != before[b]] == [str(second["rewritten"][0])]
    job = after[str(second["rewritten"][0])].split("/")[0]
    assert [d for d in os.listdir(f"{root}/data/{job}") if d.startswith("_b=")] == [f"_b={second['rewritten'][0]}"]
    assert rows_of(spark, root) == {f"p{k}": "b" if k == 7 else "a" for k in range(400)}
    # an earlier version can still be read
    assert {r.text for r in table.read(spark, root, ROWS, {"buckets": before}).collect()} == {"a"}


def test_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    table.upsert(spark.createDataFrame([("a", "1"), ("b", "1")], ROWS), root, "path", buckets=4)
    publish = table._publish

    def late(spark_, root_, version, content):  # another writer gets there first
        monkeypatch.setattr(table, "_publish", publish)
        table.upsert(spark.createDataFrame([("b", "other")], ROWS), root, "path")
        publish(spark_, root_, version, content)

    monkeypatch.setattr(table, "_publish", late)
    with pytest.raises(table.VersionConflict):
        table.upsert(spark.createDataFrame([("a", "mine")], ROWS), root, "path")
    assert rows_of(spark, root) == {"a": "1", "b": "other"} and table.latest(spark, root)[0] == 2
    table.upsert(spark.createDataFrame([("a", "mine")], ROWS), root, "path")  # started again
    assert rows_of(spark, root) == {"a": "mine", "b": "other"}
    with pytest.raises(table.VersionConflict):
        table.upsert(spark.createDataFrame([("a", "x")], ROWS), root, "path", expect=1)


def test_a_claim_of_a_dead_writer_does_not_block(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    table.upsert(spark.createDataFrame([("a", "1")], ROWS), root, "path", buckets=2)
    open(f"{root}/versions/{2:012d}.claim", "w").close()
    with pytest.raises(table.VersionConflict):
        table.upsert(spark.createDataFrame([("a", "2")], ROWS), root, "path")
    monkeypatch.setattr(table, "STALE", -1)
    assert table.upsert(spark.createDataFrame([("a", "2")], ROWS), root, "path")["version"] == 2
    assert rows_of(spark, root) == {"a": "2"}


def test_keys_that_repeat_or_are_missing(spark, tmp_path):
    root = str(tmp_path / "t")
    table.upsert(spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "1"), ("c", None)], ROWS), root, "path", buckets=2)
    got = table.upsert(spark.createDataFrame([("a", "3"), ("a", "4"), (None, "1"), ("c", None), ("d", "x")], ROWS), root, "path")
    rows = sorted(((r.path, r.text) for r in table.read(spark, root, ROWS).collect()), key=str)
    # each new row takes the place of each old one; null keys are all different
    assert rows == sorted([("a", "3"), ("a", "3"), ("a", "4"), ("a", "4"), ("b", "1"), (None, "1"), (None, "1"), ("c", None), ("d", "x")], key=str)
    assert got["changed"] == 6


def test_texts_are_shuffled_once_by_bucket(spark):
    old, new = (spark.createDataFrame([("a", "1", 0)], ROWS + ", _b int") for _ in range(2))
    plan = table._merged(old, new, "path").sortWithinPartitions("_b", "path")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
