"""Output-format and transcode plans, unit conversions.
Plans are columns: the codec work itself stays outside the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .paths import without_last_extension


def output_format_plan(df: DataFrame, path: str = "path", ext: str = "ext") -> DataFrame:
    """Source separation output (F16): wav → wav and opus → opus in place,
    any other format → ``<base>.opus``, replacing the original."""
    e = F.lower(F.col(ext))
    fmt = F.when(e == "wav", "wav").when(e == "opus", "opus").otherwise("other")
    base = F.regexp_replace(F.col(path), r"\.[^./]*$", "")
    out = F.when(e.isin("wav", "opus"), F.col(path)).otherwise(F.concat(base, F.lit(".opus")))
    return (df.withColumn("fmt", fmt).withColumn("out_path", out)
            .withColumn("replace_original", (F.col("fmt") == "other") & (F.col("out_path") != F.col(path))))


# Codec settings of the two transcode targets.
TRANSCODE_TARGETS = {
    "opus": {"codec": "libopus", "bitrate": "128k", "channels": None},
    "wav": {"codec": "pcm_s16le", "bitrate": None, "channels": 2},
}


def transcode_plan(df: DataFrame, fmt: str = "opus", path: str = "path") -> DataFrame:
    """Target path and codec for each file (F17); ``skip`` when the target
    equals the source (converting in place would overwrite the input)."""
    if fmt not in TRANSCODE_TARGETS:
        raise ValueError("format must be 'opus' or 'wav'")
    s = TRANSCODE_TARGETS[fmt]
    target = F.concat(without_last_extension(F.col(path)), F.lit("." + fmt))
    return (
        df.withColumn("target_path", target)
        .withColumn("codec", F.lit(s["codec"]))
        .withColumn("bitrate", F.lit(s["bitrate"]).cast("string"))
        .withColumn("channels", F.lit(s["channels"]).cast("int"))
        .withColumn("skip", F.col("target_path") == F.col(path))
    )


def unit_report(df: DataFrame, path: str = "path", bytes_col: str = "bytes",
                ms_col: str = "duration_ms") -> DataFrame:
    """bytes → MiB (2 decimals), ms → hours (2 decimals) and seconds.
    Rounding is integer half-up so every engine agrees."""
    return df.select(
        path,
        F.expr(f"CAST((({bytes_col} * 100 + 524288) div 1048576) AS DOUBLE) / 100").alias("mib"),
        F.expr(f"CAST((({ms_col} * 100 + 1800000) div 3600000) AS DOUBLE) / 100").alias("hours"),
        (F.col(ms_col).cast("double") / F.lit(1000.0)).alias("seconds"),
    )
