"""``{path: text}`` JSON maps (A3 read, A8 write).

Inside the engine a transcript map is a long table ``(path, text)``; JSON
objects exist only at the file edge.  Reading keeps string values only
(numbers, nulls, lists are skipped — ``from_json`` into
``map<string,string>`` would silently stringify them, so values are parsed
as VARIANT and filtered by type).  Documents that are not exactly one JSON
object (unparseable, other types, text after the object) yield no rows; of
a key given twice the last value counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import ranked
from .catalog import stage_dir


def parse_transcript_json(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Rows of JSON object text → ``(path, text)`` for string values (A3)."""
    text = F.col(json_col)
    # text after the object breaks at least one of the two wrappings
    inside = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,variant>>")
    alone = F.from_json(F.concat(F.lit('{"w":'), text, F.lit("}")), "w string")["w"].isNotNull()
    parsed = df.select(F.when(alone, inside).alias("_a")).where(F.size("_a") == 1)
    # keys in order with their positions; the last position of each key counts
    keyed = parsed.select(
        F.map_values(F.get("_a", F.lit(0))).alias("_values"),
        F.array_sort(F.transform(F.map_keys(F.get("_a", F.lit(0))),
                                 lambda k, i: F.struct(k.alias("k"), i.alias("i")))).alias("_keys"))
    last = F.filter("_keys", lambda x, j: F.coalesce(F.get("_keys", j + 1)["k"] != x["k"], F.lit(True)))
    pairs = F.transform(last, lambda x: F.struct(x["k"].alias("path"), F.get("_values", x["i"]).alias("_v")))
    return (
        keyed.select(F.inline(pairs))
        .where(F.schema_of_variant(F.col("_v")) == F.lit("STRING"))
        .select("path", F.variant_get(F.col("_v"), "$", "string").alias("text"))
    )


def read_transcript_maps(spark: SparkSession, path: str, file_name: str | None = None) -> DataFrame:
    """Read every JSON map file under ``path`` (glob allowed); one file is one
    object (``wholetext``), each file parsed by one task.  With ``file_name``
    (e.g. ``"transcription.json"``) the tree below ``path`` is searched
    recursively for files of that name, as the per-stage maps are laid out."""
    reader = spark.read.option("wholetext", "true")
    if file_name is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", file_name)
    files = reader.text(path)
    return parse_transcript_json(files, "value")


def write_transcript_map(pairs: DataFrame, key: str = "path", value: str | list[str] = "text",
                         stage: str | None = "sliced", pairs_per_object: int = 100_000) -> DataFrame:
    """One JSON object of all pairs per stage directory.

    A directory with more than ``pairs_per_object`` pairs is written as
    several objects (``part`` 0, 1, ...) so no single task ever holds a hot
    directory; :func:`read_transcript_maps` reads all parts back.  Keys are
    sorted inside each object, so output is deterministic.  ``value`` may be
    several columns (each key then maps to an object of them, as in the
    merged metadata map).  Of a key given several times the greatest value
    counts, a NULL key has no place in a map and is left out, and ``stage=None`` makes one map of all pairs
    (still split into parts).
    """
    v = F.col(value) if isinstance(value, str) else F.struct(*[F.col(c) for c in value])
    d = (F.lit("") if stage is None else
         F.coalesce(stage_dir(F.col(key), stage), F.regexp_extract(F.col(key), r"^(.*)/[^/]*$", 1)))
    with_dir = pairs.select(d.alias("stage_dir"), F.col(key).alias("k"), v.alias("v"))
    with_dir = with_dir.where(F.col("k").isNotNull()).groupBy("stage_dir", "k").agg(F.max("v").alias("v"))
    numbered = ranked(with_dir, ["stage_dir"], ["k"], rn_col="_rn")
    parts = numbered.withColumn("part", F.floor((F.col("_rn") - 1) / F.lit(pairs_per_object)).cast("bigint"))
    return parts.groupBy("stage_dir", "part").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v"))))).alias("json"),
    )


def save_transcript_maps(maps: DataFrame, out_dir: str) -> None:
    """Sink: one text file per (stage_dir, part) object, directory-partitioned."""
    (maps.select(F.regexp_replace("stage_dir", "/", "__").alias("dir_key"), "part", "json")
     .hint("rebalance", "dir_key", "part").write.mode("overwrite").partitionBy("dir_key", "part").text(out_dir))


def write_labels(labels: DataFrame, out_dir: str, stage: str = "sliced") -> None:
    """Sink for exported labels (A9): rows ``(path, label_path, label)`` as
    parquet partitioned by stage directory — one parallel write instead of
    one small text file per clip written from a single process."""
    (labels.withColumn("stage_dir", F.regexp_replace(F.coalesce(stage_dir(F.col("path"), stage), F.lit("")), "/", "__"))
     .hint("rebalance", "stage_dir").write.mode("overwrite").partitionBy("stage_dir").parquet(out_dir))
