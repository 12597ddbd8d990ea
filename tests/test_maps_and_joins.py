"""Transcript maps through files, upsert idempotence, metadata merge."""

import json
import os

from speechprep.operators import aggregates, joins
from speechprep.sources import jsonmaps


def test_map_file_round_trip(spark, tmp_path):
    good = {"/d/sliced/a.wav": "hello", "/d/sliced/b.wav": 3, "/d/sliced/c.wav": None, "/d/sliced/e.wav": "x"}
    (tmp_path / "t1.json").write_text(json.dumps(good))
    (tmp_path / "t2.json").write_text("{broken")
    (tmp_path / "t3.json").write_text("[1, 2]")
    got = {r.path: r.text for r in jsonmaps.read_transcript_maps(spark, str(tmp_path / "*.json")).collect()}
    assert got == {"/d/sliced/a.wav": "hello", "/d/sliced/e.wav": "x"}


def test_write_then_read(spark, tmp_path):
    pairs = spark.createDataFrame([(f"/r/al/sliced/{i:03d}.wav", f"t{i}") for i in range(25)], "path string, text string")
    maps = jsonmaps.write_transcript_map(pairs, pairs_per_object=10)
    assert sorted(r.n_pairs for r in maps.collect()) == [5, 10, 10]
    out = str(tmp_path / "maps")
    jsonmaps.save_transcript_maps(maps, out)
    back = jsonmaps.read_transcript_maps(spark, out + "/*/*/*.txt")
    assert sorted((r.path, r.text) for r in back.collect()) == sorted((r.path, r.text) for r in pairs.collect())


def test_map_with_repeated_keys_and_trailing_text(spark):
    docs = ['{"a": "1", "b": "2", "a": "3"}', '{"b": "9"} junk', '{"c": "9"}] junk', '{"d": "9"}} junk', '{"e": "5"}\n', "", None,
            '{"f": "1", "f": 2}']
    df = spark.createDataFrame([(x,) for x in docs], "value string")
    got = sorted((r.path, r.text) for r in jsonmaps.parse_transcript_json(df).collect())
    assert got == [("a", "3"), ("b", "2"), ("e", "5")]


def test_write_map_with_repeated_and_null_paths(spark):
    pairs = spark.createDataFrame([("/r/sliced/a", "1"), ("/r/sliced/a", "2"), (None, "3")], "path string, text string")
    (row,) = jsonmaps.write_transcript_map(pairs).collect()
    assert (row.n_pairs, json.loads(row.json)) == (1, {"/r/sliced/a": "2"})


def test_album_hours_tells_missing_albums_from_the_total(spark):
    df = spark.createDataFrame([(None, 3_600_000), ("x", 7_200_000)], "album string, duration_ms long")
    got = {(r.album, r.is_total): r.hours for r in aggregates.album_hours(df).collect()}
    assert got == {(None, 0): 1.0, ("x", 0): 2.0, (None, 1): 3.0}


def test_upsert_idempotent(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, text string")
    new = spark.createDataFrame([("b", "3"), ("c", "4")], "path string, text string")
    once = joins.upsert_transcripts(old, new)
    twice = joins.upsert_transcripts(once, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", "1"), ("b", "3"), ("c", "4")]


def test_merge_metadata_defaults(spark):
    emo = spark.createDataFrame([("a", 1), ("b", 0)], "path string, e int")
    tr = spark.createDataFrame([("a", "hi")], "path string, text string")
    de = spark.createDataFrame([("b", "desc")], "path string, d string")
    got = {r.path: (r.emotion, r.transcription, r.description) for r in joins.merge_metadata(emo, tr, de).collect()}
    assert got == {"a": (1, "hi", ""), "b": (0, "", "desc")}


def test_reassemble_chunks(spark):
    rows = [(1, 1, 1, "ab", "audio"), (1, 2, 2, "x", "frontend"), (1, 3, -3, "cd", "audio"), (1, 4, 4, "zz", "audio"),
            (2, 1, 1, "a", "audio"), (2, 2, 2, "oops", "error"),
            (3, 1, 1, "a", "audio")]
    df = spark.createDataFrame(rows, "request_id long, arrival long, sequence long, payload string, msg_type string")
    got = {r.request_id: (r.status, r.audio) for r in aggregates.reassemble_chunks(df).collect()}
    assert got == {1: ("ok", "abcd"), 2: ("failed", None), 3: ("incomplete", "a")}


def test_reassemble_binary(spark):
    rows = [(1, 1, 1, bytearray(b"\x00\x01"), "audio"), (1, 2, -2, bytearray(b"\xff"), "audio")]
    df = spark.createDataFrame(rows, "request_id long, arrival long, sequence long, payload binary, msg_type string")
    r = aggregates.reassemble_chunks(df).first()
    assert r.status == "ok" and bytes(r.audio) == b"\x00\x01\xff"


def test_write_labels(spark, tmp_path):
    from pyspark.sql import functions as F

    from speechprep.functions.text import label_text
    from speechprep.operators import joins

    tr = spark.createDataFrame([("d/a/sliced/x.1.wav", " hi "), ("d/b/sliced/y.wav", "yo")], "path string, text string")
    cat = spark.createDataFrame([("d/a/sliced/x.1.wav",)], "path string")
    labels = joins.resolve_label_path(tr, cat).select("path", "label_path", label_text(F.col("text")).alias("label"))
    jsonmaps.write_labels(labels, str(tmp_path / "labels"))
    back = {r.path: (r.label_path, r.label) for r in spark.read.parquet(str(tmp_path / "labels")).collect()}
    assert back == {"d/a/sliced/x.1.wav": ("d/a/sliced/x.txt", "hi\n"), "d/b/sliced/y.wav": ("d/b/sliced/y.txt", "yo\n")}


def test_resolve_label_path_fallback(spark):
    from speechprep.operators import joins

    tr = spark.createDataFrame([("d/a/sliced/sub/x.1.wav", "t"), ("d/a/sliced/sub/y.wav", "u")], "path string, text string")
    cat = spark.createDataFrame([("d/a/sliced/sub/y.wav",)], "path string")
    got = {r.path: (r.audio_exists, r.label_path) for r in joins.resolve_label_path(tr, cat).collect()}
    assert got == {"d/a/sliced/sub/x.1.wav": (False, "d/a/sliced/x.txt"),
                   "d/a/sliced/sub/y.wav": (True, "d/a/sliced/sub/y.txt")}


def test_pair_audio_text_and_skip(spark):
    from speechprep.operators import filters, joins

    audio = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    texts = spark.createDataFrame([("b", "x"), ("b", "y")], "path string, text string")
    got = {r.path: r.status for r in joins.pair_audio_text(audio, texts).collect()}
    assert got == {"a": "redo", "b": "complete", "c": "redo"}
    assert sorted(r.path for r in filters.skip_processed(audio, texts).collect()) == ["a", "c"]


def test_read_maps_recursively(spark, tmp_path):
    for album, pairs in {"a": {"/x/a/sliced/1.wav": "one"}, "b": {"/x/b/sliced/2.wav": "two"}}.items():
        d = tmp_path / album / "sliced"
        d.mkdir(parents=True)
        (d / "transcription.json").write_text(json.dumps(pairs))
        (d / "other.json").write_text(json.dumps({"/x/zzz.wav": "ignored"}))
    got = {r.path: r.text for r in jsonmaps.read_transcript_maps(spark, str(tmp_path), "transcription.json").collect()}
    assert got == {"/x/a/sliced/1.wav": "one", "/x/b/sliced/2.wav": "two"}


def test_merged_metadata_map(spark):
    merged = spark.createDataFrame([("/d/a.wav", 1, "hi", ""), ("/d/b.wav", 0, "", "desc")],
                                   "path string, emotion int, transcription string, description string")
    maps = jsonmaps.write_transcript_map(merged, value=["emotion", "transcription", "description"], stage=None,
                                         pairs_per_object=1).collect()
    assert len(maps) == 2
    objs = {}
    for m in maps:
        objs.update(json.loads(m.json))
    assert objs == {"/d/a.wav": {"emotion": 1, "transcription": "hi", "description": ""},
                    "/d/b.wav": {"emotion": 0, "transcription": "", "description": "desc"}}
