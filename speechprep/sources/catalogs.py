"""Landed API pages and URL lists.

Crawlers land raw JSON pages; everything after landing is a Spark job:
``from_json`` with explicit schemas (missing fields become NULL, never an
error), ``explode`` to one row per track, and per-source rules expressed as
aggregates (partial aggregation before the shuffle, so one huge source is
pre-aggregated map-side) instead of driver loops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.ordered import ranked

PROGRAM_PAGE_SCHEMA = "data struct<programs: array<struct<id: bigint, title: string>>>"


def read_url_list(lines: DataFrame, text: str = "text", src: str = "doc_id") -> DataFrame:
    """URL list files → distinct entries per list in first-seen order (A4).

    Each list (one row of ``text``; one file read with ``wholetext``) is
    de-duplicated on its own: lines are stripped, blank lines and ``#``
    comments are dropped, and a repeated entry keeps its first line number.
    The de-duplication is a ``groupBy(src, url)`` with ``min(line_no)``
    (map-side partial aggregation), so a URL repeated a billion times costs
    one counter per map task, not a hot window partition.
    """
    exploded = lines.select(F.col(src).alias("src"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "raw"))
    cleaned = exploded.select("src", "line_no", strip(F.col("raw")).alias("url"))
    kept = cleaned.where((F.col("url") != "") & ~F.col("url").startswith("#"))
    first = kept.groupBy("src", "url").agg(F.min("line_no").cast("bigint").alias("first_line"),
                                           F.count(F.lit(1)).alias("n_seen"))
    return first.select(F.col("src").alias(src), "url", "first_line", "n_seen")


def flatten_program_pages(pages: DataFrame, payload: str = "payload",
                          keys: tuple[str, ...] = ("source_id", "page_no")) -> DataFrame:
    """Program pages ``{data: {programs: [{id, title}]}}`` → one row per
    track with its position on the page (A5).  A page that does not parse
    or lacks the array yields no tracks."""
    parsed = pages.select(*keys, F.from_json(F.col(payload), PROGRAM_PAGE_SCHEMA).alias("_p"))
    return parsed.select(*keys, F.posexplode(F.col("_p.data.programs")).alias("track_pos", "_t")).select(
        *keys, F.col("track_pos").cast("bigint").alias("track_pos"), F.col("_t.id").alias("track_id"),
        F.coalesce(F.col("_t.title"), F.col("_t.id").cast("string")).alias("title"),
    )


def page_sizes(pages: DataFrame, payload: str = "payload") -> Column:
    """Number of programs on each landed page (0 when it does not parse)."""
    n = F.size(F.from_json(F.col(payload), PROGRAM_PAGE_SCHEMA)["data"]["programs"])
    return F.when(n >= 0, n).otherwise(F.lit(0)).cast("bigint")


def paginate_until_last(pages: DataFrame, n_items: Column, page_size: int, source: str = "source_id",
                        page_no: str = "page_no", total_count: Column | None = None) -> DataFrame:
    """Pages a crawler would have fetched (A7): in page order, stop before
    the first empty page, after the first short page (< ``page_size``), or
    after the page at which the running item count reaches ``total_count``.

    The stop page per source is a ``min`` aggregate (skew-safe); the running
    count, needed only with ``total_count``, uses the skew-safe ranked sum.
    """
    df = pages.withColumn("n_items", n_items)
    stop = F.when(F.col("n_items") == 0, F.col(page_no) - 1).when(F.col("n_items") < page_size, F.col(page_no))
    if total_count is not None:
        df = df.withColumn("_total", total_count)
        df = ranked(df, [source], [page_no], value_col="n_items", rn_col="_rn", cum_col="_cum").drop("_rn")
        stop = F.coalesce(stop, F.when(F.col("_cum") >= F.col("_total"), F.col(page_no)))
    stops = df.groupBy(source).agg(F.min(stop).alias("_stop"))
    kept = df.join(stops, source).where(F.col("_stop").isNull() | (F.col(page_no) <= F.col("_stop")))
    return kept.drop("_stop", "_total", "_cum")


def prefer_first_title(tracks: DataFrame, key: str, order: list[str], title: str, fallback: Column) -> DataFrame:
    """Album title = the first track's title, else the album id (B8);
    ``min_by`` is a partial aggregate, so hot albums are fine.  The title is
    cleaned like a path component ('/' and '\\' → '_', stripped)."""
    first = tracks.groupBy(key).agg(
        F.min_by(F.col(title), F.struct(*[F.col(c) for c in order])).alias("_first"),
        F.first(fallback).alias("_fallback"),
    )
    clean = strip(F.regexp_replace(F.col("_first"), r"[/\\]", "_"))
    return first.select(key, F.when(F.coalesce(F.col("_first"), F.lit("")) == "", F.col("_fallback"))
                        .otherwise(clean).alias("album_title"))


def show_manifest(episodes: DataFrame, show: str, order: list[str], episode_id: str,
                  show_cols: dict[str, Column]) -> DataFrame:
    """Show-level manifest (A10) as a long table: one row per episode with
    its ordinal, plus the show's fields and episode count.  The ordered
    episode list is never collected into one row — ordinals come from the
    skew-safe ranked helper and the count from a partial aggregate; a JSON
    writer can stream it per show."""
    counts = episodes.groupBy(show).agg(F.count(F.lit(1)).alias("episode_count"),
                                        *[F.first(v).alias(k) for k, v in show_cols.items()])
    numbered = ranked(episodes.select(show, episode_id, *order), [show], order, rn_col="ordinal")
    return numbered.join(counts, show).select(show, *show_cols.keys(), "episode_count",
                                              (F.col("ordinal") - 1).alias("ordinal"), episode_id)


def playable(meta_json: Column) -> Column:
    """``playable``, else ``is_playable``, else true; unparseable → true."""
    m = F.from_json(meta_json, "map<string,string>")
    pv = F.when(m.isNull(), F.lit(None)).otherwise(m["playable"].try_cast("boolean"))
    iv = F.when(m.isNull(), F.lit(None)).otherwise(m["is_playable"].try_cast("boolean"))
    return F.coalesce(pv, iv, F.lit(True))


def classify_availability(df: DataFrame, external_url: str, meta_json: str, exists: str) -> DataFrame:
    """Per episode: status for the free channel (external URL) and for the
    account channel (playability), plus existence (B6)."""
    ext = F.col(external_url).isNotNull() & (F.col(external_url) != "")
    free = F.when(~ext, "skipped_vip").when(F.col(exists), "exists").otherwise("download")
    play = playable(F.col(meta_json))
    paid = F.when(ext, "skipped_free").when(~play, "skipped_paywall").when(F.col(exists), "exists").otherwise("download")
    return df.withColumn("playable", play).withColumn("free_status", free).withColumn("paid_status", paid)


def pick_first_media_file(df: DataFrame, files_json: str, base_url: str, drive_base: str, video_id: str,
                          suffixes: tuple[str, ...] = (".mkv", ".mp4")) -> DataFrame:
    """First ``files[].name`` ending in a video suffix (A6); rows without one
    (or without a drive) are dropped; the content URL is
    ``<base>/<drive>/<video_id>/<file>``."""
    names = F.from_json(F.col(files_json), "array<struct<name: string>>")
    matches = F.filter(names, lambda f: _any_suffix(f["name"], suffixes))
    first = F.try_element_at(matches, F.lit(1))["name"]
    out = df.withColumn("media_file", first)
    out = out.where(F.col("media_file").isNotNull() & F.col(drive_base).isNotNull() & (F.col(drive_base) != ""))
    return out.withColumn("download_url", F.concat_ws("/", F.lit(base_url.rstrip("/")), F.col(drive_base),
                                                      F.col(video_id).cast("string"), F.col("media_file")))


def _any_suffix(name: Column, suffixes: tuple[str, ...]) -> Column:
    cond = None
    for s in suffixes:
        c = name.endswith(s)
        cond = c if cond is None else (cond | c)
    return F.coalesce(cond, F.lit(False))


def write_show_manifests(manifest: DataFrame, out_dir: str, show: str = "show_id") -> None:
    """Sink for A10: one folder per show of JSON lines (one line per
    episode with its ordinal and the show fields), written in parallel;
    readers rebuild the ordered episode list by sorting on ``ordinal``."""
    manifest.hint("rebalance", show).write.mode("overwrite").partitionBy(show).json(out_dir)
