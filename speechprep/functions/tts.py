"""Speech-synthesis request planning (F10-F12): validation of raw string
settings with ``try_cast`` (bad values fall back to defaults, never fail)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted settings and defaults of the synthesis client.
FORMATS = ("mp3", "wav", "pcm")
BITRATES = (64, 128, 192)
LATENCIES = ("normal", "balanced")
BACKENDS = ("speech-1.5", "speech-1.6", "agent-x0", "s1", "s1-mini")
DEFAULTS = {"format": "mp3", "chunk_length": 200, "mp3_bitrate": 128, "latency": "balanced",
            "backend": "speech-1.5", "top_p": 0.7, "temperature": 0.7}
CLUSTER_BY_PREFIX = {"S_": "volcano_icl"}
DEFAULT_CLUSTER = "volcano_tts"


def chunk_length(raw: Column) -> Column:
    """int(raw or 200), bad → 200, outside 100..300 → 200."""
    v = raw.try_cast("int")
    return F.when(v.between(100, 300), v).otherwise(F.lit(DEFAULTS["chunk_length"]))


def mp3_bitrate(raw: Column) -> Column:
    v = raw.try_cast("int")
    return F.when(v.isin(*BITRATES), v).otherwise(F.lit(DEFAULTS["mp3_bitrate"]))


def latency(raw: Column) -> Column:
    return F.when(raw.isin(*LATENCIES), raw).otherwise(F.lit(DEFAULTS["latency"]))


def output_format(raw: Column) -> Column:
    v = F.lower(raw)
    return F.when(v.isin(*FORMATS), v).otherwise(F.lit(DEFAULTS["format"]))


def backend(raw: Column) -> Column:
    return F.when(raw.isin(*BACKENDS), raw).otherwise(F.lit(DEFAULTS["backend"]))


def optional_int(raw: Column) -> Column:
    """int(raw) if present, bad → NULL (sample rate)."""
    return raw.try_cast("int")


def float_or(raw: Column, default: float) -> Column:
    return F.coalesce(raw.try_cast("double"), F.lit(default))


def output_path(out_dir: str, file_name: Column, fmt: Column) -> Column:
    """``out_dir / Path(name).with_suffix('.' + fmt)``."""
    from .paths import stem_last_dot

    return F.concat(F.lit(out_dir.rstrip("/") + "/"), stem_last_dot(file_name), F.lit("."), fmt)


def stem_output_path(out_dir: str, file_name: Column, encoding: Column) -> Column:
    """``out_dir / f"{name.rsplit('.', 1)[0]}.{encoding}"`` (F11, second client)."""
    stem = F.when(F.instr(file_name, ".") > 0, F.regexp_extract(file_name, r"^(.*)\.[^.]*$", 1)).otherwise(file_name)
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), stem, F.lit("."), encoding)


def voice_cluster(voice: Column, explicit: Column | None = None) -> Column:
    """Explicit cluster, else by voice prefix."""
    by_prefix = F.lit(DEFAULT_CLUSTER)
    for prefix, cluster in CLUSTER_BY_PREFIX.items():
        by_prefix = F.when(voice.startswith(prefix), F.lit(cluster)).otherwise(by_prefix)
    if explicit is None:
        return by_prefix
    return F.coalesce(F.nullif(explicit, F.lit("")), by_prefix)
