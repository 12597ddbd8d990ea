"""Audio file catalogs (A1, A2).

A catalog is a DataFrame ``(path, album, ext, bytes, mtime, duration_ms)``.
On a cluster it comes from ``binaryFile`` with the ``content`` column
pruned away (only the file listing and footer metadata are touched), and
``duration_ms`` comes from a probe run through :func:`batch_infer` or a
side table.  Extension allow-lists differ per pipeline stage and are kept
as named profiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Extension allow-lists of each pipeline stage, as in the
# reference (lower-case, without dot).  "wav_exact" is matched
# case-sensitively, all others case-insensitively.
EXTENSION_PROFILES: dict[str, tuple[str, ...]] = {
    "asr": ("mp3", "wav", "m4a", "ogg", "flac", "aac", "wma", "webm", "opus"),
    "hours": ("mp3", "wav", "m4a", "ogg", "flac", "opus"),
    "prune": ("wav", "mp3", "flac", "m4a", "aac", "ogg", "wma"),
    "vad": ("wav", "mp3", "flac", "opus", "ogg", "m4a", "aac"),
    "wav_exact": ("wav",),
    "separate": ("opus", "wav", "mp3", "flac", "m4a", "ogg", "aac", "wma"),
    "pack": ("mp3", "m4a", "mp4", "ogg", "opus", "wav", "flac"),
    "transcode": ("mp3", "flac", "m4a", "aac", "ogg", "wma", "wav"),
}
CASE_SENSITIVE_PROFILES = frozenset({"wav_exact"})


def extension_of(path: Column) -> Column:
    """Suffix after the last dot of the file name (no dot), '' if none."""
    name = F.substring_index(path, "/", -1)
    return F.when(F.instr(name, ".") > 0, F.substring_index(name, ".", -1)).otherwise(F.lit(""))


def in_profile(ext: Column, profile: str) -> Column:
    exts = list(EXTENSION_PROFILES[profile])
    if profile in CASE_SENSITIVE_PROFILES:
        return ext.isin(exts)
    return F.lower(ext).isin(exts)


def filter_extensions(catalog: DataFrame, profile: str, ext_col: str = "ext") -> DataFrame:
    """Keep rows whose extension is in the named profile (A1 predicate)."""
    return catalog.where(in_profile(F.col(ext_col), profile))


def scan_audio_files(spark: SparkSession, root: str, profile: str = "asr") -> DataFrame:
    """Recursive listing of audio files under ``root`` (A1).

    Only file metadata is selected, so Spark never reads file bodies.
    ``album`` is the directory directly below ``root``.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    root_uri = root.rstrip("/")
    path = F.regexp_replace(F.col("path"), r"^file:(//)?", "")
    rel = F.regexp_replace(path, "^" + _regex_quote(root_uri.replace("file://", "").replace("file:", "")) + "/?", "")
    cat = listing.select(
        path.alias("path"),
        F.when(F.instr(rel, "/") > 0, F.substring_index(rel, "/", 1)).alias("album"),
        extension_of(path).alias("ext"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("mtime"),
    )
    return filter_extensions(cat, profile)


def _regex_quote(s: str) -> str:
    import re

    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", s)


def stage_dir(path: Column, stage: str = "sliced") -> Column:
    """Deepest ``.../<stage>`` directory containing the file, or NULL."""
    return F.nullif(F.regexp_extract(path, rf"^(.*/{stage})/", 1), F.lit(""))


def scan_stage_dirs(catalog: DataFrame, stage: str = "sliced", root: str | None = None) -> DataFrame:
    """Distinct stage directories with their file counts (A2).

    By default a stage directory at any depth counts; with ``root`` only
    ``<root>/<album>/<stage>`` (one level below the root) does, as the hours
    report does.  A plain ``groupBy`` (partial aggregation before the
    shuffle), so a directory holding a third of all files costs one map-side
    counter.
    """
    if root is not None:
        pattern = "^(" + _regex_quote(root.rstrip("/")) + rf"/[^/]+/{stage})/"
        d = F.nullif(F.regexp_extract(F.col("path"), pattern, 1), F.lit(""))
    else:
        d = stage_dir(F.col("path"), stage)
    return (
        catalog.select(d.alias("stage_dir"))
        .where(F.col("stage_dir").isNotNull())
        .groupBy("stage_dir")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def exclude_stage_outputs(catalog: DataFrame, stage: str = "sliced") -> DataFrame:
    """Files that are not already under a ``<stage>`` directory (A2, slicer
    inputs): outputs are never re-processed."""
    return catalog.where(~F.array_contains(F.split(F.col("path"), "/"), stage))
