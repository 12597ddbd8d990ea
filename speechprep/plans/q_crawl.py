"""Crawl-data queries: URL lists, landed catalog pages, availability, page
extraction (A4-A7, A10, B6, B8, D4, G1-G4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..functions import names
from ..operators.ordered import materialize
from ..sources import catalogs, markup, pages
from .registry import query
from .sqlbits import collapse_sql, strip_sql

URL_RE = "^([A-Za-z][A-Za-z0-9+.-]*):(//([^/?#]*))?([^?#]*)(\\?([^#]*))?(#(.*))?$"
PROGRAMS_JSON = '{"data":{"programs":[{"id":"BIGINT","title":"VARCHAR"}]}}'


def _strip(x: str) -> str:
    return strip_sql(x)


# ------------------------------------------------------------------- A4
@query("read_url_list", [], f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
                  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
c AS (SELECT doc_id, line_no, {_strip("raw")} AS url FROM l),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, url ORDER BY line_no) AS rn,
             count(*) OVER (PARTITION BY doc_id, url) AS n_seen
      FROM c WHERE url <> '' AND NOT starts_with(url, '#'))
SELECT doc_id, url, CAST(line_no AS BIGINT) AS first_line, n_seen FROM k WHERE rn = 1
""")
def read_url_list(t: Tables):
    return catalogs.read_url_list(t.documents, "text", "doc_id")


# ------------------------------------------------------------- A5 A7 A10 B8
_FLAT_SQL = f"""
f0 AS (SELECT source_id, page_no, json_transform(payload, '{PROGRAMS_JSON}').data.programs AS progs FROM v_catalog),
f AS (SELECT source_id, page_no, CAST(generate_subscripts(progs, 1) - 1 AS BIGINT) AS track_pos,
             unnest(progs) AS t FROM f0),
flat AS (SELECT source_id, page_no, track_pos, t.id AS track_id, coalesce(t.title, CAST(t.id AS VARCHAR)) AS title FROM f)
"""


def _flat(t: Tables):
    return catalogs.flatten_program_pages(t.v_catalog)


@query("flatten_catalog", ["v_catalog"], "WITH " + _FLAT_SQL + "SELECT * FROM flat")
def flatten_catalog(t: Tables):
    return _flat(t)


@query("paginate_until_last", ["v_catalog"], f"""
WITH p AS (SELECT source_id, page_no,
                  CAST(coalesce(len(json_transform(payload, '{PROGRAMS_JSON}').data.programs), 0) AS BIGINT) AS n_items
           FROM v_catalog),
s AS (SELECT source_id, min(CASE WHEN n_items = 0 THEN page_no - 1 WHEN n_items < 2 THEN page_no END) AS stop
      FROM p GROUP BY source_id)
SELECT p.source_id, p.page_no, p.n_items FROM p JOIN s ON p.source_id = s.source_id
WHERE s.stop IS NULL OR p.page_no <= s.stop
""")
def paginate_until_last(t: Tables):
    return catalogs.paginate_until_last(t.v_catalog, catalogs.page_sizes(t.v_catalog), 2) \
        .select("source_id", "page_no", "n_items")


@query("prefer_first_title", ["v_catalog"], "WITH " + _FLAT_SQL + f""",
fs AS (SELECT source_id, first(title ORDER BY page_no, track_pos) AS ft FROM flat GROUP BY source_id)
SELECT source_id, CASE WHEN coalesce(ft, '') = '' THEN 'source_' || CAST(source_id AS VARCHAR)
                       ELSE {_strip("regexp_replace(ft, '[/\\\\]', '_', 'g')")} END AS album_title
FROM fs
""")
def prefer_first_title(t: Tables):
    fallback = F.concat(F.lit("source_"), F.col("source_id").cast("string"))
    return catalogs.prefer_first_title(_flat(t), "source_id", ["page_no", "track_pos"], "title", fallback)


@query("show_manifest", ["v_catalog"], "WITH " + _FLAT_SQL + """
SELECT source_id, 'show_' || CAST(source_id AS VARCHAR) AS show_name,
       COUNT(*) OVER (PARTITION BY source_id) AS episode_count,
       CAST(row_number() OVER (PARTITION BY source_id ORDER BY page_no, track_pos) - 1 AS BIGINT) AS ordinal,
       track_id
FROM flat
""")
def show_manifest(t: Tables):
    show_name = F.concat(F.lit("show_"), F.col("source_id").cast("string"))
    return catalogs.show_manifest(_flat(t), "source_id", ["page_no", "track_pos"], "track_id",
                                  {"show_name": show_name})


# ------------------------------------------------------------------- A6
_FILES_SQL = """CASE doc_id % 3
  WHEN 0 THEN '[{"name":"' || CAST(doc_id AS VARCHAR) || '.txt"}]'
  WHEN 1 THEN '[{"name":"a.txt"},{"name":"' || CAST(doc_id AS VARCHAR) || '.mp4"},{"name":"' || CAST(doc_id AS VARCHAR) || '.mkv"}]'
  ELSE '[{"name":"' || CAST(doc_id AS VARCHAR) || '.mkv"},{"name":"x.mp4"}]' END"""


@query("pick_first_media_file", ["v_names"], f"""
WITH v AS (SELECT doc_id, title, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE album END AS drive_base,
                  list_filter(from_json({_FILES_SQL}, '[{{"name":"VARCHAR"}}]'),
                              lambda f: ends_with(f.name, '.mkv') OR ends_with(f.name, '.mp4')) AS hits
           FROM v_names)
SELECT doc_id, hits[1].name AS media_file,
       'https://content.example.org/' || drive_base || '/' || CAST(doc_id AS VARCHAR) || '/' || hits[1].name AS download_url,
       CAST(doc_id AS VARCHAR) || '_' || substr({_strip("regexp_replace(title, '[\\\\/*?:\"<>|]', '', 'g')")}, 1, 100) || '.opus' AS output_file
FROM v WHERE len(hits) > 0 AND coalesce(drive_base, '') <> ''
""")
def pick_first_media_file(t: Tables):
    df = t.v_names.select(
        "doc_id", "title",
        F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("album")).alias("drive_base"),
        F.expr(_FILES_SQL.replace("VARCHAR", "STRING")).alias("files_json"),
    )
    out = catalogs.pick_first_media_file(df, "files_json", "https://content.example.org", "drive_base", "doc_id")
    return out.select("doc_id", "media_file", "download_url",
                      F.concat(F.col("doc_id").cast("string"), F.lit("_"),
                               names.cap_title(names.clean_remove(F.col("title"))), F.lit(".opus")).alias("output_file"))


# ------------------------------------------------------------------- B6
_META_SQL = """CASE doc_id % 4 WHEN 0 THEN '{"playable": false}' WHEN 1 THEN '{"is_playable": false}'
                WHEN 2 THEN '{"playable": true, "is_playable": false}' ELSE 'not json' END"""


@query("classify_availability", ["v_names"], f"""
WITH e AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN url END AS external_url, {_META_SQL} AS meta,
                  doc_id % 5 = 0 AS present FROM v_names),
p AS (SELECT *, CASE WHEN json_valid(meta) THEN coalesce(TRY_CAST(json_extract_string(meta, '$.playable') AS BOOLEAN),
                                                    TRY_CAST(json_extract_string(meta, '$.is_playable') AS BOOLEAN), true)
                     ELSE true END AS playable FROM e)
SELECT doc_id, playable,
       CASE WHEN coalesce(external_url, '') = '' THEN 'skipped_vip' WHEN present THEN 'exists' ELSE 'download' END AS free_status,
       CASE WHEN coalesce(external_url, '') <> '' THEN 'skipped_free' WHEN NOT playable THEN 'skipped_paywall'
            WHEN present THEN 'exists' ELSE 'download' END AS paid_status
FROM p
""")
def classify_availability(t: Tables):
    df = t.v_names.select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.col("url")).alias("external_url"),
        F.expr(_META_SQL).alias("meta"),
        (F.col("doc_id") % 5 == 0).alias("present"),
    )
    return catalogs.classify_availability(df, "external_url", "meta", "present") \
        .select("doc_id", "playable", "free_status", "paid_status")


# ------------------------------------------------------------- G1 G2 D4
_ORIGIN = f"regexp_extract(url, '{URL_RE}', 1) || '://' || regexp_extract(url, '{URL_RE}', 3)"
_LINK = '<a href="([^"]*)">([^<]*)</a>'


LINKS_SQL = f"""
WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS href,
                  unnest(regexp_extract_all(html, '{_LINK}', 2)) AS txt FROM pages),
k AS (SELECT page_id, txt,
             CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
                  WHEN starts_with(href, '//') THEN regexp_extract(url, '{URL_RE}', 1) || ':' || href
                  ELSE {_ORIGIN} || href END AS link
      FROM l WHERE starts_with(href, '/') AND length(href) - length(replace(href, '/', '')) >= 1)
SELECT page_id, link, min({_strip("txt")}) AS link_text FROM k GROUP BY page_id, link
"""


@query("extract_links", [], LINKS_SQL)
def extract_links(t: Tables):
    return pages.extract_links(t.pages)


@query("page_links", [], LINKS_SQL)
def page_links(t: Tables):
    """The same links by the markup tree of the pages as they stand."""
    return markup.links(t.pages, materialize(markup.page_nodes(t.pages)))


_PARA = "<p>([^<]*(?:<[^p/][^<]*|</[^p][^<]*)*)"
_ENTRIES_SQL = f"""
e0 AS (SELECT page_id,
              CASE WHEN {_strip("regexp_extract(html, '<title>([^<]*)</title>', 1)")} = '' THEN 'unknown title'
                   ELSE {_strip("regexp_extract(html, '<title>([^<]*)</title>', 1)")} END AS title,
              unnest(regexp_extract_all(html, '{_PARA}', 1)) AS raw,
              CAST(generate_subscripts(regexp_extract_all(html, '{_PARA}', 1), 1) - 1 AS BIGINT) AS entry_idx
       FROM pages),
e1 AS (SELECT page_id, title, entry_idx, {_strip("regexp_replace(raw, '<[^>]*>', '', 'g')")} AS txt FROM e0),
entries AS (SELECT page_id, title, entry_idx,
                   CASE WHEN regexp_extract(txt, '([A-F0-9]{{8}})', 1) <> '' THEN regexp_extract(txt, '([A-F0-9]{{8}})', 1)
                        ELSE 'unknown_' || CAST(entry_idx AS VARCHAR) END AS entry_id,
                   CASE WHEN txt = '' THEN 'no text' ELSE txt END AS text
            FROM e1)
""".replace("{{8}}", "{8}")


# Markup trees: every paragraph of a page becomes one piece of nested markup,
# in five shapes (by its place): a player in a table; other attribute orders,
# quotes and unclosed cells; no audio link; nested tables, no text; no table.
_PARAS = "regexp_extract_all(html, '<p>([^<]+)', 1)"
_CLEAN = r"[&<>\s]+"
_SHAPES = {
    1: """<table class="box"><tr><td><div class="downloadable-audio x"></div></td><td><a class="internal" title="VO_{id}.0B2.ogg" """
       """href="/wiki/f{i}.ogg">dl</a></td><td><span lang="zh-Hans-CN"> {p} </span></td></tr></table>""",
    2: """<TABLE><tr><td><a href='/wiki/f{i}.ogg' title='plain{i}' class='a internal b'>dl</a><span lang=zh-Hans-CN>{p}<br>tail</span>"""
       """<div id=x class='downloadable-audio'></div></table>""",
    3: """<table><tr><td><div class=downloadable-audio></div><a class="internal" href="/wiki/x.mp3">{p}</a></td></tr></table>""",
    4: """<table><tr><td><table><tr><td><div class="downloadable-audio"></div><a title="%41b" class="internal" href="f{i}.ogg">{p}</a>"""
       """</table></td></tr><span lang="zh-Hans-CN">outside</span></table>""",
    0: """<div class="downloadable-audio"></div><p>{p}</p>""",
}
_NODES = """<section id="s{i}"><p class='t a'>{p}</p><br><a HREF=/x/{i} >go</a></section>"""


def _paragraphs():
    """Clean, non-empty paragraph texts of a page."""
    found = F.regexp_extract_all("html", F.lit("<p>([^<]+)"), F.lit(1))
    return F.filter(F.transform(found, lambda p: F.btrim(F.regexp_replace(p, _CLEAN, " "))), lambda p: p != "")


_PARAGRAPHS_SQL = f"""
par AS (SELECT page_id, url, html, list_filter(list_transform({_PARAS}, lambda p: trim(regexp_replace(p, '{_CLEAN}', ' ', 'g'))),
                                               lambda p: p <> '') AS ps FROM pages),
p1 AS (SELECT page_id, url, html, unnest(ps) AS p, CAST(generate_subscripts(ps, 1) AS BIGINT) AS i FROM par)"""


def _filled(shape: str, p, i):
    """A shape with its paragraph, number and id."""
    parts, out = shape.replace("{p}", "\0p\0").replace("{id}", "\0h\0").replace("{i}", "\0i\0").split("\0"), []
    values = {"p": p, "i": i.cast("string"), "h": F.upper(F.substring(F.md5(p.cast("binary")), 1, 8))}
    for k, x in enumerate(parts):
        out.append(values[x] if k % 2 else F.lit(x))
    return F.concat(*out)


def _voice_pages(t: Tables):
    def piece(p, k):
        i = k + 1
        return F.coalesce(*[F.when(i % 5 == m, _filled(shape, p, i)) for m, shape in _SHAPES.items()])

    title = F.when(F.col("page_id") % 4 == 0, "").otherwise(
        F.concat(F.lit('<h1><span id="cosmos-title-text"> '), F.regexp_extract("html", "<title>([^<]*)", 1), F.lit(" </span></h1>")))
    body = F.array_join(F.transform(_paragraphs(), piece), "\n")
    return t.pages.select("page_id", "url", F.concat(F.lit("<html><body>"), title, body).alias("html"))


@query("extract_audio_entries", [], f"""
WITH {_PARAGRAPHS_SQL},
e AS (SELECT page_id, url, p, i, CASE i % 5 WHEN 1 THEN '/wiki/f' ELSE 'f' END || i || '.ogg' AS ref, html,
             row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS entry_idx FROM p1 WHERE i % 5 IN (1, 2, 4)),
a AS (SELECT *, CASE WHEN i % 5 = 2 THEN '/wiki/' || ref ELSE ref END AS uri FROM e)
SELECT page_id,
       CASE WHEN page_id % 4 = 0 THEN 'unknown title' ELSE {_strip("replace(regexp_extract(html, '<title>([^<]*)', 1), '&amp;', '&')")} END AS title,
       CAST(entry_idx AS BIGINT) AS entry_idx,
       CASE WHEN i % 5 = 1 THEN upper(substr(md5(p), 1, 8)) ELSE 'f' || i END AS entry_id,
       CASE i % 5 WHEN 1 THEN 'VO_' || upper(substr(md5(p), 1, 8)) || '.0B2.ogg' WHEN 2 THEN 'plain' || i ELSE 'Ab' END AS filename,
       CASE WHEN starts_with(uri, '/') THEN regexp_extract(url, '{URL_RE}', 1) || '://' || regexp_extract(url, '{URL_RE}', 3) || uri
            ELSE regexp_extract(url, '^([^?#]*/)', 1) || uri END AS audio_url,
       CASE i % 5 WHEN 1 THEN p WHEN 2 THEN p || 'tail' ELSE 'no text' END AS text
FROM a
""")
def extract_audio_entries(t: Tables):
    pages_ = _voice_pages(t)
    return markup.audio_entries(pages_, materialize(markup.page_nodes(pages_)))


@query("page_nodes", [], f"""
WITH {_PARAGRAPHS_SQL},
kinds AS (SELECT * FROM (VALUES (0, -1, 5, 1, 'section'), (1, 0, 2, 2, 'p'), (2, 1, 2, 3, '#text'), (3, 0, 3, 2, 'br'),
                                (4, 0, 5, 2, 'a'), (5, 4, 5, 3, '#text')) AS v(off, up, stop, depth, tag))
SELECT page_id, CAST(0 AS BIGINT) AS node, CAST(NULL AS BIGINT) AS parent, CAST(6 * len(ps) AS BIGINT) AS last, CAST(0 AS BIGINT) AS depth,
       'body' AS tag, CAST(NULL AS VARCHAR) AS attr, CAST(NULL AS VARCHAR) AS text FROM par
UNION ALL
SELECT page_id, (i - 1) * 6 + 1 + off, CASE WHEN up < 0 THEN 0 ELSE (i - 1) * 6 + 1 + up END, (i - 1) * 6 + 1 + stop, depth, tag,
       CASE off WHEN 0 THEN 's' || i WHEN 1 THEN 't a' WHEN 4 THEN '/x/' || i END, CASE off WHEN 2 THEN p WHEN 5 THEN 'go' END
FROM p1, kinds
""")
def page_nodes(t: Tables):
    body = F.array_join(F.transform(_paragraphs(), lambda p, k: _filled(_NODES, p, k + 1)), "")
    nodes = markup.page_nodes(t.pages.select("page_id", F.concat(F.lit("<body>"), body).alias("html")))
    return nodes.select("page_id", "node", "parent", "last", "depth", "tag",
                        F.coalesce(markup.attr("id"), markup.attr("class"), markup.attr("href")).alias("attr"), "text")


@query("entries_per_page", [], "WITH " + _ENTRIES_SQL + f""",
per AS (SELECT page_id, COUNT(*) AS n, string_agg(entry_id, ',' ORDER BY entry_idx) AS ids FROM entries GROUP BY page_id)
SELECT p.page_id,
       CASE WHEN {_strip("regexp_extract(p.html, '<title>([^<]*)</title>', 1)")} = '' THEN 'unknown title'
            ELSE {_strip("regexp_extract(p.html, '<title>([^<]*)</title>', 1)")} END AS title,
       coalesce(per.n, 0) AS n_entries, coalesce(per.n, 0) = 0 AS is_empty, coalesce(per.ids, '') AS entry_ids
FROM pages p LEFT JOIN per ON p.page_id = per.page_id
""")
def entries_per_page(t: Tables):
    return pages.entries_per_page(t.pages)


# ------------------------------------------------------------------- G3
_NEXT_SQL = """CASE WHEN page_id % 3 = 0 THEN html ELSE html ||
  '<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"channels":[{"channel_id":"c' ||
  CAST(page_id AS VARCHAR) || '","channel_name":"ch ' || CAST(page_id AS VARCHAR) ||
  '"},{"channel_id":"d' || CAST(page_id AS VARCHAR) || '"}]}}}</script>' END"""
_CHANNELS_JSON = '{"props":{"pageProps":{"channels":[{"channel_id":"VARCHAR","channel_name":"VARCHAR"}]}}}'


@query("extract_embedded_json", [], f"""
WITH j AS (SELECT page_id, json_transform(nullif(regexp_extract({_NEXT_SQL},
                     '<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), ''), '{_CHANNELS_JSON}').props.pageProps.channels AS ch
           FROM pages),
u AS (SELECT page_id, CAST(generate_subscripts(ch, 1) - 1 AS BIGINT) AS pos, unnest(ch) AS c FROM j)
SELECT page_id, pos, c.channel_id AS channel_id, c.channel_name AS channel_name FROM u
""")
def extract_embedded_json(t: Tables):
    df = t.pages.select("page_id", F.expr(_NEXT_SQL.replace("VARCHAR", "STRING")).alias("html"))
    schema = "props struct<pageProps: struct<channels: array<struct<channel_id: string, channel_name: string>>>>"
    return pages.extract_embedded_json(df, schema, ["props", "pageProps", "channels"])


# ------------------------------------------------------------------- G4
# even pages: a master list whose variants are the page's links; odd ones: a
# media list with one segment for each word of the page
_PLAYLIST_SQL = f"""CASE WHEN page_id % 2 = 0 THEN
  '#EXTM3U' || chr(10) || array_to_string(list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1),
    lambda l: '#EXT-X-STREAM-INF:BANDWIDTH=800000' || chr(10) || l || '/index.m3u8'), chr(10))
ELSE '#EXTM3U' || chr(10) || '#EXTINF:10,' || chr(10) ||
  {collapse_sql(_strip("regexp_replace(html, '<[^>]*>', ' ', 'g')"), "'.ts' || chr(10) || '#EXTINF:10,' || chr(10)")}
  || '.ts' || chr(10) || '#EXT-X-ENDLIST' END"""


def _join_rel_sql(ref: str) -> str:
    return (f"CASE WHEN regexp_matches({ref}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {ref} "
            f"WHEN starts_with({ref}, '//') THEN regexp_extract(url, '{URL_RE}', 1) || ':' || {ref} "
            f"WHEN starts_with({ref}, '/') THEN {_ORIGIN} || {ref} "
            f"ELSE regexp_extract(url, '^([^?#]*/)', 1) || {ref} END")


@query("explode_playlist", [], f"""
WITH p AS (SELECT page_id, url, {_PLAYLIST_SQL} AS pl FROM pages),
u AS (SELECT page_id, url, pl,
             list_transform(list_filter(regexp_split_to_array(pl, '\r\n|\r|\n'),
                                        lambda l: l <> '' AND NOT starts_with(l, '#')),
                            lambda l: {_strip("l")}) AS uris FROM p),
seg AS (SELECT page_id, url, CAST(generate_subscripts(uris, 1) - 1 AS BIGINT) AS seg_idx, unnest(uris) AS uri
        FROM u WHERE strpos(pl, '#EXT-X-STREAM-INF') = 0)
SELECT page_id, seg_idx, {_join_rel_sql("uri")} AS seg_url, printf('%05d.ts', seg_idx) AS local_name, 'segment' AS kind FROM seg
UNION ALL
SELECT page_id, CAST(0 AS BIGINT) AS seg_idx, {_join_rel_sql("uris[1]")} AS seg_url, CAST(NULL AS VARCHAR) AS local_name,
       'variant' AS kind
FROM u WHERE strpos(pl, '#EXT-X-STREAM-INF') > 0 AND len(uris) > 0
""")
def explode_playlist(t: Tables):
    from ..functions.text import WS_CLASS_JAVA, strip

    words = strip(F.regexp_replace("html", "<[^>]*>", " "))
    media = F.concat(F.lit("#EXTM3U\n#EXTINF:10,\n"), F.regexp_replace(words, WS_CLASS_JAVA + "+", ".ts\n#EXTINF:10,\n"),
                     F.lit(".ts\n#EXT-X-ENDLIST"))
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    master = F.concat(F.lit("#EXTM3U\n"), F.array_join(F.transform(links, lambda x: F.concat(
        F.lit("#EXT-X-STREAM-INF:BANDWIDTH=800000\n"), x, F.lit("/index.m3u8"))), "\n"))
    df = t.pages.select("page_id", "url", F.when(F.col("page_id") % 2 == 0, master).otherwise(media).alias("pl"))
    return pages.explode_playlist(df, "pl", "url")
