"""Timed lyrics (B7, F14, F15) as higher-order array expressions: a song's
text is parsed inside its own row, no shuffle and no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

# The word/line time stamp ``[mm:ss.xx]`` / ``[mm:ss.xxx]``.
STAMP_RE = r"\[(\d{2}):(\d{2})\.(\d{2,3})\]"
STAMP_SPLIT_RE = r"\[\d{2}:\d{2}\.\d{2,3}\]"


def stamp_ms(stamp: Column) -> Column:
    """``[mm:ss.ff]`` → ms; a 2-digit fraction is centiseconds (×10)."""
    frac = F.regexp_extract(stamp, STAMP_RE, 3)
    return (
        F.regexp_extract(stamp, STAMP_RE, 1).cast("int") * 60000
        + F.regexp_extract(stamp, STAMP_RE, 2).cast("int") * 1000
        + F.when(F.length(frac) == 2, frac.cast("int") * 10).otherwise(frac.cast("int"))
    ).cast("bigint")


def _line_words(line: Column) -> Column:
    stamps = F.regexp_extract_all(line, F.lit(STAMP_RE), 0)
    # the text after each stamp, split once a line
    after = F.filter(F.split(line, STAMP_SPLIT_RE), lambda _, i: i > 0)
    words = F.zip_with(stamps, after, lambda s, w: F.struct(stamp_ms(s).alias("time_ms"),
                                                            F.coalesce(w, F.lit("")).alias("text")))
    return F.filter(words, lambda w: w["text"] != "")


def parsed_lyrics(text: Column) -> Column:
    """``array<array<struct<time_ms, text>>>``: lines with at least one
    non-empty word, words with their start time (F14)."""
    lines = F.split(strip(text), "\n")
    lines = F.filter(lines, lambda l: strip(l) != "")
    return F.filter(F.transform(lines, _line_words), lambda ws: F.size(ws) > 0)


def explode_word_lyrics(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per word ``(key, line_no, word_no, time_ms, text)``; line and
    word numbers count only kept lines / words (F14)."""
    lines = df.select(key, F.posexplode(parsed_lyrics(F.col(text))).alias("line_no", "_words"))
    words = lines.select(key, "line_no", F.posexplode("_words").alias("word_no", "_w"))
    return words.select(
        key, F.col("line_no").cast("bigint").alias("line_no"), F.col("word_no").cast("bigint").alias("word_no"),
        F.col("_w.time_ms").alias("time_ms"), F.col("_w.text").alias("text"),
    )


def lyric_tag(lrc: Column, tag: str, default: str = "unknown", max_lines: int = 20) -> Column:
    """Value of ``[tag:...]`` among the first ``max_lines`` lines; the last
    match wins; stripped; ``default`` when absent (F15)."""
    pattern = rf"^\[{tag}:\s*(.+)\]"
    head = F.slice(F.split(F.coalesce(lrc, F.lit("")), "\n"), 1, max_lines)
    hits = F.filter(head, lambda l: l.rlike(pattern))
    last = F.try_element_at(hits, F.lit(-1))
    return F.when(last.isNull(), F.lit(default)).otherwise(strip(F.regexp_extract(last, pattern, 1)))


def has_stamp(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(STAMP_SPLIT_RE)


def filter_lyrics(df: DataFrame, yrc: str = "yrc", klyric: str | None = None, lrc: str = "lrc") -> DataFrame:
    """Keep songs with word-level text, or line text with at least one time
    stamp (B7).  ``source`` is yrc, else klyric, else lrc; ``lrc_kept`` is
    the line text only when it carries stamps."""
    y = F.coalesce(F.col(yrc), F.lit(""))
    k = F.coalesce(F.col(klyric), F.lit("")) if klyric else F.lit("")
    word = F.when(y != "", y).otherwise(k)
    lrc_ok = (F.coalesce(F.col(lrc), F.lit("")) != "") & has_stamp(F.col(lrc))
    source = F.when(y != "", "yrc").when(k != "", "klyric").otherwise("lrc")
    return df.where((word != "") | lrc_ok).withColumn("source", source).withColumn(
        "word_text", word).withColumn("lrc_kept", F.when(lrc_ok, F.col(lrc)).otherwise(F.lit("")))
