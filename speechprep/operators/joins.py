"""Equi-joins on path / id keys.

All joins are declarative so Catalyst/AQE choose the strategy: the big
sides are shuffled once on the key (sort-merge or shuffled hash), and a
side whose *runtime* size is under the broadcast threshold is broadcast
by AQE.  Only dictionaries of fixed, known size are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths


def merge_metadata(emotion: DataFrame, transcription: DataFrame, description: DataFrame,
                   key: str = "path") -> DataFrame:
    """One record per emotion key with transcription and description, missing
    sides as '' (C1).  Both joins are on the same key, so Spark shuffles
    each input once and the second join reuses the first one's partitioning."""
    t = transcription.select(F.col(key), F.col(transcription.columns[1]).alias("transcription"))
    d = description.select(F.col(key), F.col(description.columns[1]).alias("description"))
    e = emotion.select(F.col(key), F.col(emotion.columns[1]).alias("emotion"))
    return (
        e.join(t, on=key, how="left")
        .join(d, on=key, how="left")
        .select(
            key,
            "emotion",
            F.coalesce(F.col("transcription"), F.lit("")).alias("transcription"),
            F.coalesce(F.col("description"), F.lit("")).alias("description"),
        )
    )


def upsert_transcripts(existing: DataFrame, new: DataFrame, key: str = "path",
                       value: str = "text") -> DataFrame:
    """existing ∪ new with the new value winning per key (C2): one full outer
    join, i.e. a single co-partitioned shuffle of both sides.  Idempotent:
    upserting the same ``new`` twice gives the same table."""
    o = existing.select(F.col(key), F.col(value).alias("_old"))
    n = new.select(F.col(key), F.col(value).alias("_new"))
    return o.join(n, on=key, how="full").select(
        key, F.coalesce(F.col("_new"), F.col("_old")).alias(value)
    )


def resolve_label_path(transcripts: DataFrame, catalog: DataFrame, key: str = "path",
                       stage: str = "sliced") -> DataFrame:
    """Where each transcript's ``.txt`` label goes.

    The stem is the key's last path component up to its *first* dot.  If the
    audio exists (present in ``catalog``) the label sits beside it, else in
    the stage directory the transcript map belongs to.
    """
    present = catalog.select(F.col(key)).distinct().withColumn("_exists", F.lit(True))
    stem = paths.stem_first_dot(paths.file_name(F.col(key)))
    audio_dir = paths.parent_dir(F.col(key))
    map_dir = F.coalesce(
        F.nullif(F.regexp_extract(F.col(key), rf"^(.*/{stage})/", 1), F.lit("")), audio_dir
    )
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    return (
        transcripts.join(present, on=key, how="left")
        .withColumn("audio_exists", exists)
        .withColumn(
            "label_path",
            F.concat(F.when(exists, audio_dir).otherwise(map_dir), F.lit("/"), stem, F.lit(".txt")),
        )
        .drop("_exists")
    )


def pair_audio_text(audio: DataFrame, texts: DataFrame, key: str = "path") -> DataFrame:
    """``complete`` when both the audio and its text exist, else ``redo`` (C4).
    Equivalent to a left-semi / left-anti split in one left join against the
    distinct text keys."""
    have = texts.select(F.col(key)).distinct().withColumn("_has_text", F.lit(True))
    return (
        audio.join(have, on=key, how="left")
        .withColumn(
            "status",
            F.when(F.col("_has_text").isNotNull(), F.lit("complete")).otherwise(F.lit("redo")),
        )
        .drop("_has_text")
    )


# Common language aliases → ISO 639-1, as in the reference.
LANG_ALIASES: dict[str, str] = {
    "hin": "hi", "hindi": "hi",
    "eng": "en", "english": "en",
    "spa": "es", "spanish": "es",
    "fra": "fr", "french": "fr",
    "deu": "de", "german": "de",
    "jpn": "ja", "japanese": "ja",
    "kor": "ko", "korean": "ko",
    "zho": "zh", "chinese": "zh",
    "por": "pt", "portuguese": "pt",
    "ita": "it", "italian": "it",
    "rus": "ru", "russian": "ru",
    "ara": "ar", "arabic": "ar",
}


def alias_table(spark) -> DataFrame:
    """The alias dictionary as a 24-row DataFrame (fixed size: safe to broadcast)."""
    return spark.createDataFrame(sorted(LANG_ALIASES.items()), "alias string, iso string")


def join_language_alias(df: DataFrame, col: str, out: str = "lang_code") -> DataFrame:
    """Alias → ISO code, identity when the alias is unknown.

    The dictionary has a fixed 24 entries, so it is broadcast explicitly; the
    big side is never shuffled."""
    spark = df.sparkSession
    aliases = F.broadcast(alias_table(spark))
    return (
        df.join(aliases, df[col] == aliases["alias"], "left")
        .withColumn(out, F.coalesce(F.col("iso"), F.col(col)))
        .drop("alias", "iso")
    )
