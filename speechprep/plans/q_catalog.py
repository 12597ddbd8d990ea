"""Catalog, filter, join and aggregate queries (A1-A3, A8, A9, B1-B4,
C1-C5, D1-D3, D5, D6, E11, E12, F16-F18) and the flagship query."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..functions.text import label_text, strip
from ..operators import aggregates, batching, dealing, filters, infer, joins, passes, upsert_table
from ..session import checkpoint_dir
from ..sources import catalog as cat
from ..sources import jsonmaps
from .registry import query
from .sqlbits import strip_sql


def _sql_in(profile: str) -> str:
    return ", ".join(f"'{e}'" for e in cat.EXTENSION_PROFILES[profile])


ASR = _sql_in("asr")


def _asr(t: Tables):
    return cat.filter_extensions(t.v_audio, "asr")


# --------------------------------------------------------------------------
# Flagship: hours still to transcribe, per album and in total.
# --------------------------------------------------------------------------
@query("flagship_backlog_hours", ["v_audio", "v_done"], f"""
SELECT album, CAST(SUM(duration_ms) AS BIGINT) AS total_ms, COUNT(duration_ms) AS n_readable,
       COUNT(*) AS n_files, CAST(GROUPING(album) AS INTEGER) AS is_total,
       CAST((CAST(SUM(duration_ms) AS BIGINT) * 100 + 1800000) // 3600000 AS DOUBLE) / 100 AS hours
FROM v_audio a
WHERE lower(ext) IN ({ASR}) AND duration_ms >= 0
  AND NOT EXISTS (SELECT 1 FROM v_done d WHERE d.path = a.path)
GROUP BY ROLLUP (album)
""")
def flagship_backlog_hours(t: Tables):
    todo = filters.skip_processed(_asr(t), t.v_done)
    todo = filters.filter_duration_range(todo, 0, None)
    return aggregates.album_hours(todo)


# --------------------------------------------------------------------------
# A1 / A2
# --------------------------------------------------------------------------
_PROFILE_FLAGS = ["hours", "prune", "vad", "separate", "pack", "transcode"]


@query("scan_audio_files", ["v_audio"], f"""
SELECT doc_id, path, album, ext, bytes, duration_ms,
       {", ".join(f"lower(ext) IN ({_sql_in(p)}) AS in_{p}" for p in _PROFILE_FLAGS)},
       ext IN ('wav') AS in_wav_exact
FROM v_audio WHERE lower(ext) IN ({ASR})
""")
def scan_audio_files(t: Tables):
    flags = [cat.in_profile(F.col("ext"), p).alias(f"in_{p}") for p in _PROFILE_FLAGS]
    flags.append(cat.in_profile(F.col("ext"), "wav_exact").alias("in_wav_exact"))
    return _asr(t).select("doc_id", "path", "album", "ext", "bytes", "duration_ms", *flags)


@query("scan_stage_dirs", ["v_audio"], f"""
SELECT regexp_extract(path, '^(.*/sliced)/', 1) AS stage_dir, COUNT(*) AS n_files
FROM v_audio WHERE lower(ext) IN ({ASR}) AND regexp_extract(path, '^(.*/sliced)/', 1) <> ''
GROUP BY 1
""")
def scan_stage_dirs(t: Tables):
    return cat.scan_stage_dirs(_asr(t))


# --------------------------------------------------------------------------
# Transcript maps and labels
# --------------------------------------------------------------------------
@query("read_transcript_map", ["v_old"], "SELECT path, text FROM v_old")
def read_transcript_map(t: Tables):
    # v_old written as {path: text} JSON documents per stage dir (A8), plus a
    # malformed document and one with non-string values, then read back (A3).
    docs = jsonmaps.write_transcript_map(t.v_old).select("stage_dir", "json")
    # next to every real document: one with only non-string values and one
    # that does not parse; both must contribute no rows
    junk = docs.select("stage_dir", F.lit('{"x": 1, "y": null, "z": ["a"]}').alias("json")).unionByName(
        docs.select("stage_dir", F.lit("{not json").alias("json")))
    return jsonmaps.parse_transcript_json(docs.unionByName(junk), "json").select("path", "text")


@query("write_transcript_map", ["v_old"], """
SELECT regexp_extract(path, '^(.*/sliced)/', 1) AS stage_dir, CAST(0 AS BIGINT) AS part, COUNT(*) AS n_pairs,
       CAST(to_json(map_from_entries(list(struct_pack(k := path, v := text) ORDER BY path))) AS VARCHAR) AS json
FROM v_old GROUP BY 1
""")
def write_transcript_map(t: Tables):
    return jsonmaps.write_transcript_map(t.v_old)


@query("export_labels", ["v_old", "v_audio"], f"""
SELECT o.path,
       CASE WHEN a.path IS NOT NULL THEN regexp_extract(o.path, '^(.*)/[^/]*$', 1)
            ELSE coalesce(nullif(regexp_extract(o.path, '^(.*/sliced)/', 1), ''),
                          regexp_extract(o.path, '^(.*)/[^/]*$', 1)) END
         || '/' || split_part(regexp_extract(o.path, '([^/]*)$', 1), '.', 1) || '.txt' AS label_path,
       {strip_sql("o.text")} || chr(10) AS label
FROM v_old o LEFT JOIN (SELECT DISTINCT path FROM v_audio WHERE lower(ext) IN ({ASR})) a ON o.path = a.path
""")
def export_labels(t: Tables):
    resolved = joins.resolve_label_path(t.v_old, _asr(t))
    return resolved.select("path", "label_path", label_text(F.col("text")).alias("label"))


# --------------------------------------------------------------------------
# B1-B4
# --------------------------------------------------------------------------
@query("filter_duration_range", ["v_audio"], f"""
SELECT path, duration_ms FROM v_audio
WHERE lower(ext) IN ({ASR}) AND duration_ms >= 0 AND duration_ms <= 30000
""")
def filter_duration_range(t: Tables):
    return filters.filter_duration_range(_asr(t), 0, 30000).select("path", "duration_ms")


@query("prune_clips", ["v_audio"], f"""
SELECT path, duration_ms,
       CASE WHEN duration_ms IS NULL THEN 'unreadable' WHEN duration_ms < 5000 THEN 'short'
            WHEN duration_ms > 45000 THEN 'long' ELSE 'keep' END AS verdict,
       NOT (duration_ms IS NOT NULL AND (duration_ms < 5000 OR duration_ms > 45000)) AS keep
FROM v_audio WHERE lower(ext) IN ({_sql_in("prune")})
""")
def prune_clips(t: Tables):
    return filters.prune_clips(cat.filter_extensions(t.v_audio, "prune")).select(
        "path", "duration_ms", "verdict", "keep")


@query("skip_processed", ["v_audio", "v_done"], f"""
SELECT path, album, duration_ms FROM v_audio a
WHERE lower(ext) IN ({ASR}) AND NOT EXISTS (SELECT 1 FROM v_done d WHERE d.path = a.path)
""")
def skip_processed(t: Tables):
    return filters.skip_processed(_asr(t), t.v_done).select("path", "album", "duration_ms")


@query("route_by_duration", ["v_audio", "v_done"], f"""
SELECT path, duration_ms,
       CASE WHEN duration_ms IS NULL THEN 'unreadable' WHEN duration_ms <= 30000 THEN 'short' ELSE 'long' END AS route,
       CASE WHEN duration_ms IS NULL THEN NULL WHEN duration_ms <= 30000 THEN 1 ELSE 2 END AS pass_no
FROM v_audio a
WHERE lower(ext) IN ({ASR}) AND NOT EXISTS (SELECT 1 FROM v_done d WHERE d.path = a.path)
""")
def route_by_duration(t: Tables):
    todo = filters.skip_processed(_asr(t), t.v_done)
    return filters.route_by_duration(todo).select("path", "duration_ms", "route", "pass_no")


# --------------------------------------------------------------------------
# C1-C5
# --------------------------------------------------------------------------
@query("merge_metadata", ["v_done", "v_old", "v_description"], """
SELECT e.path, e.quality AS emotion, coalesce(o.text, '') AS transcription,
       coalesce(d.description, '') AS description
FROM v_done e LEFT JOIN v_old o ON e.path = o.path LEFT JOIN v_description d ON e.path = d.path
""")
def merge_metadata(t: Tables):
    return joins.merge_metadata(t.v_done.select("path", "quality"), t.v_old, t.v_description)


@query("upsert_transcripts", ["v_old", "v_new"], """
SELECT coalesce(n.path, o.path) AS path, coalesce(n.text, o.text) AS text
FROM v_old o FULL OUTER JOIN v_new n ON o.path = n.path
""")
def upsert_transcripts(t: Tables):
    return joins.upsert_transcripts(t.v_old, t.v_new)


@query("upsert_bucketed", ["v_old", "v_new"], """
SELECT coalesce(n.path, o.path) AS path, coalesce(n.text, o.text) AS text
FROM v_old o FULL OUTER JOIN v_new n ON o.path = n.path
""")
def upsert_bucketed(t: Tables):
    """The old map landed as a bucketed table, the new one applied twice."""
    root = f"{checkpoint_dir(t.spark)}/transcripts-{uuid.uuid4().hex}"
    for rows in (t.v_old, t.v_new, t.v_new):
        upsert_table.upsert(rows.select("path", "text"), root, "path")
    return upsert_table.read(t.spark, root, "path string, text string")


class _Fails(infer.WordsTranscriber):
    """A stand-in that can't read clips whose text holds ``bad``."""

    def __init__(self, bad: str):
        self.bad = bad

    def __call__(self, texts):
        if any(self.bad in (x or "") for x in texts):
            raise RuntimeError("decoder failed")
        return super().__call__(texts)


def _words(x: str) -> str:
    from ..functions.text import WS_CLASS_RE2

    return f"array_to_string(regexp_split_to_array({strip_sql(x)}, '{WS_CLASS_RE2}+'), ' ')"


@query("two_pass_run", ["v_audio"], f"""
WITH c AS (SELECT a.path, a.duration_ms AS d, coalesce(d.text, '') AS x FROM v_audio a JOIN documents d ON a.doc_id = d.doc_id
           WHERE a.duration_ms IS NOT NULL),
f AS (SELECT *, {strip_sql("x")} = '' AS blank, d <= 30000 AND strpos(x, 'an') > 0 AS bad1, d >= 30000 AND strpos(x, 'zu') > 0 AS bad2 FROM c)
SELECT path, CASE WHEN d > 30000 THEN 'long' WHEN d = 30000 THEN 'both' ELSE 'short' END AS route,
       CASE WHEN d > 30000 OR (d = 30000 AND (bad1 OR blank)) THEN 2 ELSE 1 END AS pass,
       CASE WHEN blank OR (d < 30000 AND bad1) OR (d > 30000 AND bad2) OR (d = 30000 AND bad1 AND bad2) THEN NULL ELSE {_words("x")} END AS text,
       CASE WHEN (d < 30000 AND bad1) OR (d > 30000 AND bad2) OR (d = 30000 AND bad1 AND bad2) THEN 'RuntimeError: decoder failed'
            WHEN blank THEN 'ValueError: empty input' END AS error
FROM f
""")
def two_pass_run(t: Tables):
    """Short clips, then long ones and the 30-second ones that failed, into one
    table; a run that is repeated finds nothing to do."""
    clips = t.v_audio.join(t.documents.select("doc_id", "text"), "doc_id").select("path", "duration_ms", "text")
    root = f"{checkpoint_dir(t.spark)}/passes-{uuid.uuid4().hex}"

    def model(bad: str):
        return lambda df: infer.batch_infer(df, "path", ["text"], loader=lambda: _Fails(bad), predict=lambda m, b: m(b["text"]))

    steps = passes.two_passes("duration_ms", model("an"), model("zu"))
    passes.run(clips, root, steps, chunks=2, buckets=8)
    d = F.col("duration_ms")
    route = F.when(d > 30000, "long").when(d == 30000, "both").otherwise("short")
    return passes.results(t.spark, root).join(clips.select("path", route.alias("route")), "path").select("path", "route", "pass", "text", "error")


_DEAL_SQL = """
WITH r AS (SELECT path, duration_ms, greatest(coalesce(duration_ms, 0), 0) AS c,
                  row_number() OVER (ORDER BY greatest(coalesce(duration_ms, 0), 0) DESC, path) - 1 AS k FROM v_audio),
d AS (SELECT *, CASE WHEN (k // 7) % 2 = 0 THEN k % 7 ELSE 6 - k % 7 END AS task_no FROM r),
b AS (SELECT *, CAST((sum(c) OVER (PARTITION BY task_no ORDER BY c DESC, path ROWS UNBOUNDED PRECEDING) - c) // 600000 AS BIGINT) AS batch_no FROM d)
"""


@query("balance_batches", ["v_audio"], _DEAL_SQL + "SELECT path, duration_ms, CAST(task_no AS BIGINT) AS task_no, batch_no FROM b")
def balance_batches(t: Tables):
    return dealing.deal_by_cost(t.v_audio.select("path", "duration_ms"), "path", "duration_ms", tasks=7, batch_cost=600_000)


@query("resolve_label_path", ["v_old", "v_audio"], f"""
SELECT o.path, a.path IS NOT NULL AS audio_exists,
       CASE WHEN a.path IS NOT NULL THEN regexp_extract(o.path, '^(.*)/[^/]*$', 1)
            ELSE coalesce(nullif(regexp_extract(o.path, '^(.*/sliced)/', 1), ''),
                          regexp_extract(o.path, '^(.*)/[^/]*$', 1)) END
         || '/' || split_part(regexp_extract(o.path, '([^/]*)$', 1), '.', 1) || '.txt' AS label_path
FROM v_old o LEFT JOIN (SELECT DISTINCT path FROM v_audio WHERE lower(ext) IN ({ASR})) a ON o.path = a.path
""")
def resolve_label_path(t: Tables):
    return joins.resolve_label_path(t.v_old, _asr(t)).select("path", "audio_exists", "label_path")


@query("pair_audio_text", ["v_audio", "v_old"], f"""
SELECT a.path, CASE WHEN EXISTS (SELECT 1 FROM v_old o WHERE o.path = a.path) THEN 'complete' ELSE 'redo' END AS status
FROM v_audio a WHERE lower(ext) IN ({ASR})
""")
def pair_audio_text(t: Tables):
    return joins.pair_audio_text(_asr(t).select("path"), t.v_old)


def _alias_values_sql() -> str:
    return ", ".join(f"('{a}', '{i}')" for a, i in sorted(joins.LANG_ALIASES.items()))


@query("join_language_alias", ["v_names"], f"""
SELECT n.doc_id, n.lang_main, coalesce(m.iso, n.lang_main) AS lang_code
FROM (SELECT doc_id, CASE WHEN x = '' THEN '' ELSE regexp_split_to_array(x, '[-_.]')[1] END AS lang_main
      FROM (SELECT doc_id, lower({strip_sql("lang_tag")}) AS x FROM v_names) n0) n
LEFT JOIN (VALUES {_alias_values_sql()}) AS m(alias, iso) ON n.lang_main = m.alias
""")
def join_language_alias(t: Tables):
    main = F.split(F.lower(strip(F.col("lang_tag"))), r"[-_.]").getItem(0)
    df = t.v_names.select("doc_id", main.alias("lang_main"))
    return joins.join_language_alias(df, "lang_main")


# --------------------------------------------------------------------------
# D1-D3, D5, D6
# --------------------------------------------------------------------------
@query("album_hours", ["v_audio"], f"""
SELECT album, CAST(SUM(duration_ms) AS BIGINT) AS total_ms, COUNT(duration_ms) AS n_readable,
       COUNT(*) AS n_files, CAST(GROUPING(album) AS INTEGER) AS is_total,
       CAST((CAST(SUM(duration_ms) AS BIGINT) * 100 + 1800000) // 3600000 AS DOUBLE) / 100 AS hours
FROM v_audio WHERE lower(ext) IN ({_sql_in("hours")})
GROUP BY ROLLUP (album)
""")
def album_hours(t: Tables):
    return aggregates.album_hours(cat.filter_extensions(t.v_audio, "hours"))


@query("stage_counters", ["v_audio"], f"""
SELECT album, COUNT(*) AS total,
       CAST(count_if(v = 'keep') AS BIGINT) AS n_keep, CAST(count_if(v = 'short') AS BIGINT) AS n_short,
       CAST(count_if(v = 'long') AS BIGINT) AS n_long, CAST(count_if(v = 'unreadable') AS BIGINT) AS n_unreadable
FROM (SELECT album, CASE WHEN duration_ms IS NULL THEN 'unreadable' WHEN duration_ms < 5000 THEN 'short'
                         WHEN duration_ms > 45000 THEN 'long' ELSE 'keep' END AS v
      FROM v_audio WHERE lower(ext) IN ({_sql_in("prune")})) p
GROUP BY album
""")
def stage_counters(t: Tables):
    pruned = filters.prune_clips(cat.filter_extensions(t.v_audio, "prune"))
    return aggregates.stage_counters(pruned, "album", "verdict", ["keep", "short", "long", "unreadable"])


@query("batch_progress", ["v_lyrics"], """
SELECT batch_no, attempted, hits,
       CAST(SUM(hits) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_hits,
       CAST(SUM(attempted) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_attempted
FROM (SELECT CAST(floor(song_id / 50) AS BIGINT) AS batch_no, COUNT(*) AS attempted,
             CAST(count_if(yrc <> '') AS BIGINT) AS hits FROM v_lyrics GROUP BY 1) b
""")
def batch_progress(t: Tables):
    return aggregates.batch_progress(t.v_lyrics, "song_id", F.col("yrc") != "", 50)


@query("concat_segments", [], f"""
SELECT conv_id, {strip_sql("string_agg(text, '' ORDER BY turn)")} AS text
FROM conversations GROUP BY conv_id
""")
def concat_segments(t: Tables):
    return aggregates.concat_segments(t.conversations, "conv_id", "turn", "text")


_CHUNK_TYPE_SQL = "CASE payload WHEN 'error' THEN 'error' WHEN 'view' THEN 'frontend' ELSE 'audio' END"


def _chunks(t: Tables):
    # Fixture mapping of message kinds: 'view' rows are front-end results,
    # 'error' rows are failures, everything else is audio.
    return t.v_chunks.withColumn(
        "msg_type",
        F.when(F.col("payload") == "error", "error").when(F.col("payload") == "view", "frontend").otherwise("audio"),
    )


@query("reassemble_chunks", ["v_chunks"], f"""
WITH m AS (SELECT *, {_CHUNK_TYPE_SQL} AS msg_type FROM v_chunks),
g AS (SELECT request_id,
             min(CASE WHEN msg_type = 'audio' AND sequence < 0 THEN arrival END) AS term,
             min(CASE WHEN msg_type NOT IN ('audio', 'frontend') THEN arrival END) AS err
      FROM m GROUP BY request_id),
b AS (SELECT g.request_id, g.term, g.err,
             coalesce(string_agg(m.payload, '' ORDER BY m.arrival) FILTER (WHERE m.msg_type = 'audio'
                      AND (g.term IS NULL OR m.arrival <= g.term)), '') AS body,
             count(*) FILTER (WHERE m.msg_type = 'audio' AND (g.term IS NULL OR m.arrival <= g.term)) AS n
      FROM g JOIN m ON g.request_id = m.request_id GROUP BY g.request_id, g.term, g.err)
SELECT request_id,
       CASE WHEN err IS NOT NULL AND (term IS NULL OR err < term) THEN 'failed'
            WHEN term IS NULL THEN 'incomplete' WHEN length(body) = 0 THEN 'empty' ELSE 'ok' END AS status,
       CASE WHEN err IS NOT NULL AND (term IS NULL OR err < term) THEN NULL ELSE body END AS audio,
       CAST(CASE WHEN err IS NOT NULL AND (term IS NULL OR err < term) THEN 0 ELSE n END AS BIGINT) AS n_chunks
FROM b
""")
def reassemble_chunks(t: Tables):
    return aggregates.reassemble_chunks(_chunks(t))


# --------------------------------------------------------------------------
# E11 / E12
# --------------------------------------------------------------------------
@query("assign_batches", ["v_audio"], f"""
SELECT path, regexp_extract(path, '^(.*/sliced)/', 1) AS stage_dir,
       CAST((row_number() OVER (PARTITION BY regexp_extract(path, '^(.*/sliced)/', 1) ORDER BY path) - 1) // 256 AS BIGINT) AS batch_no
FROM v_audio WHERE lower(ext) IN ({ASR})
""")
def assign_batches(t: Tables):
    df = _asr(t).select("path", cat.stage_dir(F.col("path")).alias("stage_dir"))
    return batching.assign_batches(df, "stage_dir", "path", 256)


@query("split_evenly", ["v_audio"], f"""
SELECT path, album, CAST(ntile(4) OVER (PARTITION BY album ORDER BY path) - 1 AS BIGINT) AS part
FROM v_audio WHERE lower(ext) IN ({_sql_in("separate")})
""")
def split_evenly(t: Tables):
    df = cat.filter_extensions(t.v_audio, "separate").select("path", "album")
    return batching.split_evenly(df, "album", "path", 4)


# --------------------------------------------------------------------------
# F16-F18
# --------------------------------------------------------------------------
@query("output_format_plan", ["v_audio"], f"""
SELECT path, fmt, out_path, fmt = 'other' AND out_path <> path AS replace_original FROM (
  SELECT path, CASE lower(ext) WHEN 'wav' THEN 'wav' WHEN 'opus' THEN 'opus' ELSE 'other' END AS fmt,
         CASE WHEN lower(ext) IN ('wav', 'opus') THEN path
              ELSE regexp_replace(path, '\\.[^./]*$', '') || '.opus' END AS out_path
  FROM v_audio WHERE lower(ext) IN ({_sql_in("separate")})) s
""")
def output_format_plan(t: Tables):
    from ..functions import media

    return media.output_format_plan(cat.filter_extensions(t.v_audio, "separate")).select(
        "path", "fmt", "out_path", "replace_original")


@query("transcode_plan", ["v_audio"], f"""
SELECT path, regexp_replace(path, '\\.[^.]*$', '') || '.wav' AS target_path, 'pcm_s16le' AS codec,
       CAST(NULL AS STRING) AS bitrate, 2 AS channels,
       regexp_replace(path, '\\.[^.]*$', '') || '.wav' = path AS skip
FROM v_audio WHERE lower(ext) IN ({_sql_in("transcode")})
""")
def transcode_plan(t: Tables):
    from ..functions import media

    return media.transcode_plan(cat.filter_extensions(t.v_audio, "transcode"), "wav").select(
        "path", "target_path", "codec", "bitrate", "channels", "skip")


@query("unit_report", ["v_audio"], """
SELECT path, CAST((bytes * 100 + 524288) // 1048576 AS DOUBLE) / 100 AS mib,
       CAST((duration_ms * 100 + 1800000) // 3600000 AS DOUBLE) / 100 AS hours,
       CAST(duration_ms AS DOUBLE) / 1000 AS seconds
FROM v_audio
""")
def unit_report(t: Tables):
    from ..functions import media

    return media.unit_report(t.v_audio)
