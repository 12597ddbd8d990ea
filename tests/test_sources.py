"""File-system sources and sinks on a scratch tree."""

import os

from pyspark.sql import functions as F

from speechprep.operators import packing
from speechprep.sources import catalog


def _touch(path, n):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"\0" * n)


def test_scan_audio_files(spark, tmp_path):
    root = tmp_path / "data"
    _touch(str(root / "albumA" / "sliced" / "a_000.WAV"), 10)
    _touch(str(root / "albumA" / "raw.flac"), 20)
    _touch(str(root / "albumB" / "b.mp3"), 30)
    _touch(str(root / "albumB" / "notes.txt"), 5)
    cat = catalog.scan_audio_files(spark, str(root), profile="asr")
    got = {os.path.basename(r.path): (r.album, r.ext, r.bytes) for r in cat.collect()}
    assert got == {"a_000.WAV": ("albumA", "WAV", 10), "raw.flac": ("albumA", "flac", 20), "b.mp3": ("albumB", "mp3", 30)}
    assert all(r.path.startswith("/") for r in cat.collect())
    # wav profile is case-sensitive: the upper-case .WAV is not picked up
    assert catalog.scan_audio_files(spark, str(root), profile="wav_exact").count() == 0
    # slicer inputs exclude files already under a sliced directory
    assert {os.path.basename(r.path) for r in catalog.exclude_stage_outputs(cat).collect()} == {"raw.flac", "b.mp3"}
    dirs = catalog.scan_stage_dirs(cat).collect()
    assert len(dirs) == 1 and dirs[0].stage_dir.endswith("albumA/sliced") and dirs[0].n_files == 1
    deep = spark.createDataFrame([("data/a/sliced/x.wav",), ("data/a/b/sliced/y.wav",)], "path string")
    assert sorted(r.stage_dir for r in catalog.scan_stage_dirs(deep).collect()) == ["data/a/b/sliced", "data/a/sliced"]
    assert [r.stage_dir for r in catalog.scan_stage_dirs(deep, root="data").collect()] == ["data/a/sliced"]


def test_partitioned_export_sink(spark, tmp_path):
    import datetime as dt

    rows = [("en", f"f{i}", 6, dt.datetime(2024, 1, 1, 0, 0, i)) for i in range(4)] + \
           [("de", "g0", 20, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "bucket string, name string, bytes long, mtime timestamp_ntz")
    packed = packing.pack_volumes(df, 10, "2030-01-01 00:00:00", 60, slices=2)
    manifest = packing.volume_manifest(packed, "2024-01-02 03:04:05", prefix="vol/")
    out = str(tmp_path / "exp")
    packing.write_partitioned_export(manifest, out)
    back = spark.read.parquet(out)
    assert sorted(d for d in os.listdir(out) if d.startswith("lang=")) == ["lang=de", "lang=en"]
    keys = sorted(r.object_key for r in back.collect())
    assert keys == ["vol/de/de_20240102_030405_000.tar", "vol/en/en_20240102_030405_000.tar",
                    "vol/en/en_20240102_030405_001.tar", "vol/en/en_20240102_030405_002.tar",
                    "vol/en/en_20240102_030405_003.tar"]
    assert back.where(F.col("lang") == "en").agg(F.sum("n_files")).first()[0] == 4
