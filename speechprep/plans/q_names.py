"""Name, path, URL, label, TTS and lyric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..functions import lyrics, names, paths, tts, urls
from ..functions.text import label_text, strip
from ..operators import batching
from ..operators.joins import LANG_ALIASES
from .registry import query
from .sqlbits import collapse_sql, rstrip_sql, strip_sql

# -------------------------------------------------------------- SQL helpers
ILLEGAL = '[\\\\/*?:"<>|]'
URL_RE = "^([A-Za-z][A-Za-z0-9+.-]*):(//([^/?#]*))?([^?#]*)(\\?([^#]*))?(#(.*))?$"


def _strip(x: str) -> str:
    return strip_sql(x)


def _left(x: str, n: str) -> str:
    return f"substr({x}, 1, CASE WHEN ({n}) >= 0 THEN ({n}) ELSE greatest(length({x}) + ({n}), 0) END)"


def _has_ext(x: str) -> str:
    head = f"substr({x}, 1, length({x}) - strpos(reverse({x}), '.'))"
    return f"(strpos(reverse({x}), '.') > 0 AND length(replace({head}, '.', '')) > 0)"


def _root(x: str) -> str:
    return f"CASE WHEN {_has_ext(x)} THEN substr({x}, 1, length({x}) - strpos(reverse({x}), '.')) ELSE {x} END"


def _ext(x: str) -> str:
    return f"CASE WHEN {_has_ext(x)} THEN substr({x}, length({x}) - strpos(reverse({x}), '.') + 1) ELSE '' END"


def _capped(x: str) -> str:
    s = collapse_sql(f"regexp_replace({x}, '{ILLEGAL}', '', 'g')")
    capped = f"{_left(_root(s), '50 - length(' + _ext(s) + ')')} || {_ext(s)}"
    return _strip(f"CASE WHEN length({s}) > 50 THEN {capped} ELSE {s} END")


# ------------------------------------------------------------------- F1
@query("sanitize_names", ["v_names"], f"""
SELECT doc_id,
  {_strip(collapse_sql(f"regexp_replace(title, '{ILLEGAL}', '_', 'g')"))} AS name_replace,
  {_capped("title")} AS name_capped,
  {_strip(f"regexp_replace(title, '{ILLEGAL}', '', 'g')")} AS name_removed,
  {_strip("regexp_replace(title, '[/\\\\]', '_', 'g')")} AS name_slashes,
  {rstrip_sql("regexp_replace(title, '[^\\p{L}\\p{N} _-]', '', 'g')")} AS name_alnum,
  substr(replace(regexp_replace(title, '[/\\\\]', '_', 'g'), chr(0), ''), 1, 200) AS name_slashes_nul
FROM v_names
""")
def sanitize_names(t: Tables):
    c = F.col("title")
    return t.v_names.select(
        "doc_id",
        names.clean_replace(c).alias("name_replace"),
        names.clean_capped(c).alias("name_capped"),
        names.clean_remove(c).alias("name_removed"),
        names.clean_slashes(c).alias("name_slashes"),
        names.clean_alnum(c).alias("name_alnum"),
        names.clean_slashes_nul(c).alias("name_slashes_nul"),
    )


# ------------------------------------------------------------------- F2
def _trunc_sql(x: str, n: int) -> str:
    cut = f"substr({x}, 1, {n})"
    ls = f"CASE WHEN strpos(reverse({cut}), ' ') > 0 THEN length({cut}) - strpos(reverse({cut}), ' ') ELSE -1 END"
    backed = f"CASE WHEN ({ls}) >= {int(n * 0.6)} AND ({ls}) > 0 THEN substr({cut}, 1, {ls}) ELSE {cut} END"
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE {rstrip_sql(backed)} END"


@query("truncate_words", ["v_names"], f"""
SELECT doc_id, {_trunc_sql("t", 120)} AS short_title
FROM (SELECT doc_id, {_strip(collapse_sql(f"regexp_replace(title, '{ILLEGAL}', '_', 'g')"))} AS t
      FROM v_names) s
""")
def truncate_words(t: Tables):
    return t.v_names.select("doc_id", names.truncate_words(names.clean_replace(F.col("title")), 120).alias("short_title"))


# ------------------------------------------------------------------- F3
@query("cap_path_length", ["v_names"], f"""
SELECT doc_id, album_dir,
  CASE WHEN length(album_dir) + 1 + length(f) <= 250 THEN f
       WHEN 250 - length(album_dir) - 1 > 10
         THEN {_left(_root("f"), "250 - length(album_dir) - 1 - length(" + _ext("f") + ")")} || {_ext("f")}
       ELSE 'episode_' || CAST(doc_id AS VARCHAR) || '.mp3' END AS episode_file,
  CAST(doc_id AS VARCHAR) || '_' || substr(rg, 1, 100) || '.opus' AS archive_file
FROM (SELECT doc_id, f, rg,
        CASE WHEN length(d0) > 200 THEN 'data/' || album || '/' || {_left("tt", "100 - (length(d0) - 200)")} ELSE d0 END AS album_dir
      FROM (SELECT doc_id, album, tt, 'data/' || album || '/' || substr(tt, 1, 100) AS d0,
                   z || '.mp3' AS f, rg
            FROM (SELECT doc_id, album, CASE WHEN z = '' THEN album ELSE z END AS tt, z, rg
                  FROM (SELECT doc_id, album, {_capped("title")} AS z,
                               {_strip(f"regexp_replace(title, '{ILLEGAL}', '', 'g')")} AS rg FROM v_names) a) b) c) d
""")
def cap_path_length(t: Tables):
    df = t.v_names.select("doc_id", "album", names.clean_capped(F.col("title")).alias("z"),
                          names.clean_remove(F.col("title")).alias("rg"))
    lang_dir = F.concat(F.lit("data/"), F.col("album"))
    album_dir = names.cap_album_dir(lang_dir, F.col("z"), F.col("album"))
    return df.select(
        "doc_id",
        album_dir.alias("album_dir"),
        names.cap_episode_file(album_dir, F.concat(F.col("z"), F.lit(".mp3")), F.col("doc_id")).alias("episode_file"),
        F.concat(F.col("doc_id").cast("string"), F.lit("_"), names.cap_title(F.col("rg")), F.lit(".opus")).alias("archive_file"),
    )


# ------------------------------------------------------------------- F4
def _guess_ext_sql() -> str:
    path = f"lower(CASE WHEN regexp_extract(url, '{URL_RE}', 1) <> '' THEN regexp_extract(url, '{URL_RE}', 4) ELSE regexp_extract(url, '^([^?#]*)', 1) END)"
    parts = [f"WHEN ends_with({path}, '{e}') THEN '{e}'" for e in urls.PATH_EXTENSIONS]
    ct = "lower(coalesce(content_type, ''))"
    for needles, e in urls.CONTENT_TYPE_RULES:
        cond = " OR ".join(f"strpos({ct}, '{n}') > 0" for n in needles)
        parts.append(f"WHEN {cond} THEN '{e}'")
    return "CASE " + " ".join(parts) + " ELSE '.mp3' END"


@query("guess_extension", ["v_names"], f"SELECT doc_id, {_guess_ext_sql()} AS ext FROM v_names")
def guess_extension(t: Tables):
    return t.v_names.select("doc_id", urls.guess_extension(F.col("url"), F.col("content_type")).alias("ext"))


# ------------------------------------------------------------------- F5
def _alias_case(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = '{a}' THEN '{i}'" for a, i in sorted(LANG_ALIASES.items())) + f" ELSE {x} END"


@query("normalize_language", ["v_names"], f"""
SELECT doc_id, CASE WHEN lang_tag IS NULL OR lang_tag = '' THEN 'unknown' ELSE {_alias_case("m")} END AS lang
FROM (SELECT doc_id, lang_tag,
             CASE WHEN x = '' THEN '' ELSE regexp_split_to_array(x, '[-_.]')[1] END AS m
      FROM (SELECT doc_id, lang_tag, lower({_strip("lang_tag")}) AS x FROM v_names) a) b
""")
def normalize_language(t: Tables):
    return t.v_names.select("doc_id", names.normalize_language(F.col("lang_tag")).alias("lang"))


# ------------------------------------------------------------------- F6
_RID_URL_SQL = """CASE doc_id % 4
  WHEN 0 THEN 'https://open.example.org/show/' || substr(md5(CAST(doc_id AS STRING)), 1, 22)
  WHEN 1 THEN 'https://open.example.org/intl-es/episode/' || substr(md5(CAST(doc_id AS STRING)), 1, 22) || '?si=x'
  WHEN 2 THEN 'example:show:' || substr(md5(CAST(doc_id AS STRING)), 1, 22)
  ELSE 'https://open.example.org/show/' || substr(md5(CAST(doc_id AS STRING)), 1, 10) END"""
_HOST = r"[A-Za-z0-9.-]+"


def _rid_sql(kind: str) -> str:
    pat = f"(?:{_HOST}/(?:intl-[a-z-]+/)?{kind}/|[a-z]+:{kind}:)([A-Za-z0-9]{{22}})"
    return f"nullif(regexp_extract(url, '{pat}', 1), '')"


@query("parse_resource_ids", [], f"""
SELECT doc_id, url, {_rid_sql("show")} AS show_id, {_rid_sql("episode")} AS episode_id
FROM (SELECT doc_id, {_RID_URL_SQL} AS url FROM documents) u
""")
def parse_resource_ids(t: Tables):
    md5 = F.md5(F.col("doc_id").cast("string"))
    m = F.col("doc_id") % 4
    url = (F.when(m == 0, F.concat(F.lit("https://open.example.org/show/"), F.substring(md5, 1, 22)))
           .when(m == 1, F.concat(F.lit("https://open.example.org/intl-es/episode/"), F.substring(md5, 1, 22), F.lit("?si=x")))
           .when(m == 2, F.concat(F.lit("example:show:"), F.substring(md5, 1, 22)))
           .otherwise(F.concat(F.lit("https://open.example.org/show/"), F.substring(md5, 1, 10))))
    df = t.documents.select("doc_id", url.alias("url"))
    return df.select("doc_id", "url", urls.resource_id(F.col("url"), "show").alias("show_id"),
                     urls.resource_id(F.col("url"), "episode").alias("episode_id"))


# ------------------------------------------------------------------- F7
def _sfx(x: str) -> str:
    dot = f"(length({x}) - strpos(reverse({x}), '.') + 1)"
    return (f"CASE WHEN strpos({x}, '.') > 0 AND {dot} > 1 AND {dot} < length({x}) "
            f"THEN substr({x}, {dot}) ELSE '' END")


def _stem(x: str) -> str:
    return f"CASE WHEN {_sfx(x)} = '' THEN {x} ELSE substr({x}, 1, length({x}) - length({_sfx(x)})) END"



@query("path_parts", ["v_names"], f"""
SELECT doc_id, p AS path, fname AS file_name, split_part(fname, '.', 1) AS stem_first_dot,
       {_stem("fname")} AS stem_last_dot,
       {_sfx("fname")} AS suffix,
       regexp_extract(p, '^(.*)/[^/]*$', 1) AS parent,
       regexp_extract(p, '^(.*)/[^/]*$', 1) || '/' ||
         ({_stem("fname")}) || '.txt' AS label_file
FROM (SELECT doc_id, p, regexp_extract(p, '([^/]*)$', 1) AS fname
      FROM (SELECT doc_id, 'data/' || album || '/' || {_strip("regexp_replace(title, '[/\\\\]', '_', 'g')")} AS p FROM v_names) a) b
""")
def path_parts(t: Tables):
    p = F.concat(F.lit("data/"), F.col("album"), F.lit("/"), names.clean_slashes(F.col("title")))
    df = t.v_names.select("doc_id", p.alias("path"))
    fname = paths.file_name(F.col("path"))
    return df.select(
        "doc_id", "path", fname.alias("file_name"),
        paths.stem_first_dot(fname).alias("stem_first_dot"),
        paths.stem_last_dot(fname).alias("stem_last_dot"),
        paths.suffix(fname).alias("suffix"),
        paths.parent_dir(F.col("path")).alias("parent"),
        paths.with_suffix(F.col("path"), ".txt").alias("label_file"),
    )


# ------------------------------------------------------------------- F8
@query("url_rewrite", [], f"""
SELECT page_id,
  regexp_extract(url, '{URL_RE}', 1) || '://' || regexp_extract(url, '{URL_RE}', 3) || regexp_extract(url, '{URL_RE}', 4) AS base,
  regexp_extract(url, '{URL_RE}', 1) || '://' || regexp_extract(url, '{URL_RE}', 3) || regexp_extract(url, '{URL_RE}', 4)
    || '?podcastIds=' || coalesce(nullif(regexp_extract(regexp_extract(url, '{URL_RE}', 6), '(?:^|&)utm_source=([^&]*)', 1), ''), 'unknown')
    || '&count=100&offset=' || CAST(page_id * 100 AS VARCHAR) AS paged_url,
  {_strip("regexp_replace(url_decode(regexp_extract(regexp_extract(url, URL_PLACEHOLDER, 4), '([^/]*)$', 1) || '%EF%BC%88x%EF%BC%89'), '（.*?）', '', 'g')").replace("URL_PLACEHOLDER", "'" + URL_RE + "'")} AS decoded_name,
  regexp_extract(url, '{URL_RE}', 1) || '://' || regexp_extract(url, '{URL_RE}', 3) || '/wiki/' || CAST(page_id AS VARCHAR) AS abs_link
FROM pages
""")
def url_rewrite(t: Tables):
    u = F.col("url")
    base = F.concat(urls.url_scheme(u), F.lit("://"), urls.url_host(u), urls.url_path(u))
    query_str = F.concat(F.lit("podcastIds="), F.coalesce(urls.query_param(u, "utm_source"), F.lit("unknown")),
                         F.lit("&count=100&offset="), (F.col("page_id") * 100).cast("string"))
    last_seg = F.regexp_extract(urls.url_path(u), r"([^/]*)$", 1)
    # the fixture adds an encoded "（x）" suffix so decoding and the
    # full-width-parenthesis rule are both exercised
    decoded = urls.strip_fullwidth_parens(F.try_url_decode(F.concat(last_seg, F.lit("%EF%BC%88x%EF%BC%89"))))
    return t.pages.select(
        "page_id", base.alias("base"), urls.with_query(base, query_str).alias("paged_url"),
        decoded.alias("decoded_name"),
        urls.join_url(u, F.concat(F.lit("/wiki/"), F.col("page_id").cast("string"))).alias("abs_link"),
    )


# ------------------------------------------------------------------- F9
@query("label_text", ["v_old"], f"SELECT path, {_strip('text')} || chr(10) AS label FROM v_old")
def label_text_q(t: Tables):
    return t.v_old.select("path", label_text(F.col("text")).alias("label"))


# --------------------------------------------------------------- F10-F12
@query("tts_request_params", ["v_tts"], """
SELECT request_id,
  CASE WHEN TRY_CAST(chunk_length AS INTEGER) BETWEEN 100 AND 300 THEN TRY_CAST(chunk_length AS INTEGER) ELSE 200 END AS chunk_length,
  CASE WHEN TRY_CAST(mp3_bitrate AS INTEGER) IN (64, 128, 192) THEN TRY_CAST(mp3_bitrate AS INTEGER) ELSE 128 END AS mp3_bitrate,
  CASE WHEN latency IN ('normal', 'balanced') THEN latency ELSE 'balanced' END AS latency,
  'mp3' AS format, 'speech-1.5' AS backend,
  TRY_CAST(mp3_bitrate AS INTEGER) AS sample_rate,
  coalesce(TRY_CAST(chunk_length AS DOUBLE), 0.7) AS top_p,
  coalesce(TRY_CAST(latency AS DOUBLE), 0.7) AS temperature
FROM v_tts
""")
def tts_request_params(t: Tables):
    return t.v_tts.select(
        "request_id",
        tts.chunk_length(F.col("chunk_length")).alias("chunk_length"),
        tts.mp3_bitrate(F.col("mp3_bitrate")).alias("mp3_bitrate"),
        tts.latency(F.col("latency")).alias("latency"),
        tts.output_format(F.lit(None).cast("string")).alias("format"),
        tts.backend(F.lit(None).cast("string")).alias("backend"),
        # the fixture's raw strings double as the optional numeric settings:
        # a present-or-NULL rate, and floats that fall back on a bad cast
        tts.optional_int(F.col("mp3_bitrate")).alias("sample_rate"),
        tts.float_or(F.col("chunk_length"), tts.DEFAULTS["top_p"]).alias("top_p"),
        tts.float_or(F.col("latency"), tts.DEFAULTS["temperature"]).alias("temperature"),
    )


@query("tts_output_path", ["v_tts"], f"""
SELECT request_id,
  'out/' || ({_stem("file_name")}) || '.mp3' AS out_path,
  'out/' || (CASE WHEN strpos(file_name, '.') > 0 THEN regexp_extract(file_name, '^(.*)\\.[^.]*$', 1)
                  ELSE file_name END) || '.wav' AS stem_path
FROM v_tts
""")
def tts_output_path(t: Tables):
    fn = F.col("file_name")
    return t.v_tts.select("request_id", tts.output_path("out", fn, F.lit("mp3")).alias("out_path"),
                          tts.stem_output_path("out", fn, F.lit("wav")).alias("stem_path"))


@query("voice_cluster", ["v_tts"], """
SELECT request_id, voice,
       CASE WHEN starts_with(voice, 'S_') THEN 'volcano_icl' ELSE 'volcano_tts' END AS cluster,
       CASE WHEN request_id % 5 = 0 THEN 'custom' ELSE
            CASE WHEN starts_with(voice, 'S_') THEN 'volcano_icl' ELSE 'volcano_tts' END END AS cluster_explicit
FROM v_tts
""")
def voice_cluster(t: Tables):
    explicit = F.when(F.col("request_id") % 5 == 0, F.lit("custom")).otherwise(F.lit(None).cast("string"))
    return t.v_tts.select("request_id", "voice", tts.voice_cluster(F.col("voice")).alias("cluster"),
                          tts.voice_cluster(F.col("voice"), explicit).alias("cluster_explicit"))


# ------------------------------------------------------------------ F13
@query("artifact_names", ["v_files"], f"""
SELECT name,
  printf('%s_%s_%03d.tar', bucket, strftime(mtime, '%Y%m%d_%H%M%S'), bytes % 1000) AS volume_name,
  printf('%s_%03d%s', {_stem("name")},
         bytes % 1500, '.wav') AS piece_name,
  printf('%s_%d.wav', split_part(name, '.', 1), bytes % 13) AS chunk_name,
  'transcription_' || bucket || '.json' AS transcript_name
FROM v_files
""")
def artifact_names(t: Tables):
    n = F.col("name")
    return t.v_files.select(
        "name",
        names.volume_name(F.col("bucket"), F.col("mtime"), F.col("bytes") % 1000).alias("volume_name"),
        names.piece_name(paths.stem_last_dot(n), F.col("bytes") % 1500, F.lit(".wav")).alias("piece_name"),
        names.chunk_name(paths.stem_first_dot(n), F.col("bytes") % 13).alias("chunk_name"),
        names.transcript_file_name(F.col("bucket")).alias("transcript_name"),
    )


# ------------------------------------------------------------ F14 F15 B7
_WORDS_SQL = f"""
WITH l AS (SELECT song_id, unnest(string_split({_strip("yrc")}, chr(10))) AS line,
                  generate_subscripts(string_split({_strip("yrc")}, chr(10)), 1) AS lpos
           FROM v_lyrics),
w AS (SELECT song_id, lpos, unnest(regexp_extract_all(line, '\\[(\\d{{2}}):(\\d{{2}})\\.(\\d{{2,3}})\\]', 0)) AS stamp,
             generate_subscripts(regexp_extract_all(line, '\\[(\\d{{2}}):(\\d{{2}})\\.(\\d{{2,3}})\\]', 0), 1) AS wi,
             string_split_regex(line, '\\[\\d{{2}}:\\d{{2}}\\.\\d{{2,3}}\\]') AS parts
      FROM l WHERE {_strip("line")} <> ''),
y AS (SELECT song_id, lpos, wi, stamp, parts[wi + 1] AS text FROM w WHERE coalesce(parts[wi + 1], '') <> '')
SELECT song_id,
       CAST(dense_rank() OVER (PARTITION BY song_id ORDER BY lpos) - 1 AS BIGINT) AS line_no,
       CAST(row_number() OVER (PARTITION BY song_id, lpos ORDER BY wi) - 1 AS BIGINT) AS word_no,
       CAST(CAST(substr(stamp, 2, 2) AS INTEGER) * 60000 + CAST(substr(stamp, 5, 2) AS INTEGER) * 1000 +
            CASE WHEN length(regexp_extract(stamp, '\\.(\\d+)\\]', 1)) = 2
                 THEN CAST(regexp_extract(stamp, '\\.(\\d+)\\]', 1) AS INTEGER) * 10
                 ELSE CAST(regexp_extract(stamp, '\\.(\\d+)\\]', 1) AS INTEGER) END AS BIGINT) AS time_ms,
       text
FROM y
"""


@query("parse_word_lyrics", ["v_lyrics"], _WORDS_SQL)
def parse_word_lyrics(t: Tables):
    return lyrics.explode_word_lyrics(t.v_lyrics, "song_id", "yrc")


def _tag_sql(tag: str) -> str:
    pat = f"^\\[{tag}:\\s*(.+)\\]"
    hits = f"list_filter(string_split(coalesce(lrc, ''), chr(10))[1:20], lambda x: regexp_matches(x, '{pat}'))"
    return (f"CASE WHEN len({hits}) = 0 THEN 'unknown' "
            f"ELSE {_strip(f'regexp_extract({hits}[-1], {chr(39)}{pat}{chr(39)}, 1)')} END")


@query("lyric_tags", ["v_lyrics"], f"SELECT song_id, {_tag_sql('ti')} AS title, {_tag_sql('ar')} AS artist FROM v_lyrics")
def lyric_tags(t: Tables):
    return t.v_lyrics.select("song_id", lyrics.lyric_tag(F.col("lrc"), "ti").alias("title"),
                             lyrics.lyric_tag(F.col("lrc"), "ar").alias("artist"))


@query("filter_lyrics", ["v_lyrics"], """
SELECT song_id, CASE WHEN coalesce(yrc, '') <> '' THEN 'yrc' ELSE 'lrc' END AS source,
       CASE WHEN coalesce(lrc, '') <> '' AND regexp_matches(lrc, '\\[\\d{2}:\\d{2}\\.\\d{2,3}\\]') THEN lrc ELSE '' END AS lrc_kept
FROM v_lyrics
WHERE coalesce(yrc, '') <> '' OR (coalesce(lrc, '') <> '' AND regexp_matches(lrc, '\\[\\d{2}:\\d{2}\\.\\d{2,3}\\]'))
""")
def filter_lyrics(t: Tables):
    return lyrics.filter_lyrics(t.v_lyrics).select("song_id", "source", "lrc_kept")


# ------------------------------------------------------------------ E15
@query("dedupe_names", ["v_names"], f"""
WITH n0 AS (SELECT doc_id, album, {_strip("title")} || '.mp3' AS name FROM v_names),
f AS (SELECT *, row_number() OVER (PARTITION BY album, name ORDER BY doc_id) AS rn, {_root("name")} AS root, {_ext("name")} AS ext FROM n0),
t AS (SELECT album, regexp_replace(root, '_[0-9]+$', '') AS root, ext, list(CAST(regexp_extract(root, '_([0-9]+)$', 1) AS BIGINT)) AS used
      FROM f WHERE rn = 1 AND regexp_matches(root, '_(0[1-9]|[1-9][0-9]+)$') GROUP BY ALL),
j AS (SELECT f.*, coalesce(t.used, []) AS used FROM f LEFT JOIN t ON f.album = t.album AND f.root = t.root AND f.ext = t.ext)
SELECT doc_id, album, CASE WHEN rn = 1 THEN name ELSE
       root || '_' || printf('%02d', list_filter(range(1, rn + len(used)), lambda x: NOT list_contains(used, x))[rn - 1]) || ext
       END AS unique_name
FROM j
""")
def dedupe_names(t: Tables):
    df = t.v_names.select("doc_id", "album",
                          F.concat(strip(F.col("title")), F.lit(".mp3")).alias("name"))
    return batching.dedupe_names(df, "album", "name", "doc_id").select("doc_id", "album", "unique_name")
