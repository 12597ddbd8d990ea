"""Page extraction (G1-G4, D4) as Spark jobs over a ``pages`` table.

Regex extraction over machine-made pages: links, titles, paragraph entries,
embedded JSON and playlists become rows with built-in ``regexp_extract_all``
/ ``posexplode`` / ``from_json``.  Each page is handled inside its own row;
no page is ever sent to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import strip

LINK_RE = r'<a href="([^"]*)">([^<]*)</a>'
TITLE_RE = r"<title>([^<]*)</title>"
# a <p> block runs to the next <p> or </p> (unclosed paragraphs end at the next one)
PARAGRAPH_RE = r"<p>([^<]*(?:<[^p/][^<]*|</[^p][^<]*)*)"
TAG_RE = r"<[^>]*>"
NEXT_DATA_RE = r'<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'


def extract_links(pages: DataFrame, prefix: str = "/", min_slashes: int = 1, key: str = "page_id",
                  url: str = "url", html: str = "html") -> DataFrame:
    """Distinct absolute links per page whose href starts with ``prefix``
    and holds at least ``min_slashes`` slashes (G1)."""
    links = pages.select(
        key, url,
        F.explode(F.arrays_zip(F.regexp_extract_all(F.col(html), F.lit(LINK_RE), 1).alias("href"),
                               F.regexp_extract_all(F.col(html), F.lit(LINK_RE), 2).alias("text"))).alias("_l"),
    )
    href = F.col("_l.href")
    n_slash = F.length(href) - F.length(F.regexp_replace(href, "/", ""))
    kept = links.where(href.startswith(prefix) & (n_slash >= min_slashes))
    absolute = urls.join_url(F.col(url), href)
    return kept.groupBy(key, absolute.alias("link")).agg(F.min(strip(F.col("_l.text"))).alias("link_text"))


def page_title(html: Column, default: str = "unknown title") -> Column:
    t = strip(F.regexp_extract(html, TITLE_RE, 1))
    return F.when(t == "", F.lit(default)).otherwise(t)


def extract_entries(pages: DataFrame, key: str = "page_id", html: str = "html",
                    default_text: str = "no text", id_re: str = r"([A-F0-9]{8})") -> DataFrame:
    """Per page: title (default) and one row per paragraph entry with its
    text (tags removed, stripped, default when empty) and an id found by
    ``id_re`` or the fallback ``unknown_<index>`` (G2)."""
    paras = pages.select(key, page_title(F.col(html)).alias("title"),
                         F.posexplode(F.regexp_extract_all(F.col(html), F.lit(PARAGRAPH_RE), 1)).alias("entry_idx", "_raw"))
    text = strip(F.regexp_replace(F.col("_raw"), TAG_RE, ""))
    found = F.regexp_extract(text, id_re, 1)
    return paras.select(
        key, "title", F.col("entry_idx").cast("bigint").alias("entry_idx"),
        F.when(found != "", found).otherwise(F.concat(F.lit("unknown_"), F.col("entry_idx").cast("string"))).alias("entry_id"),
        F.when(text == "", F.lit(default_text)).otherwise(text).alias("text"),
    )


def entries_per_page(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Title, entry count and entry ids per page; pages without entries are
    kept with count 0 and flagged (D4).  The count is per page (a page is
    one row), so the aggregate never spans pages."""
    entries = extract_entries(pages, key, html)
    per = entries.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entry_idx", "entry_id"))),
                                 lambda s: s["entry_id"]), ",").alias("entry_ids"))
    base = pages.select(key, page_title(F.col(html)).alias("title"))
    return base.join(per, key, "left").select(
        key, "title", F.coalesce(F.col("n_entries"), F.lit(0)).alias("n_entries"),
        F.coalesce(F.col("n_entries"), F.lit(0)).__eq__(0).alias("is_empty"),
        F.coalesce(F.col("entry_ids"), F.lit("")).alias("entry_ids"))


def extract_embedded_json(pages: DataFrame, schema: str, path: list[str], key: str = "page_id",
                          html: str = "html") -> DataFrame:
    """JSON inside ``<script id="__NEXT_DATA__">`` → one row per element of
    the array at ``path`` (G3); missing tag or level → no rows."""
    raw = F.regexp_extract(F.col(html), NEXT_DATA_RE, 1)
    parsed = pages.select(key, F.from_json(F.nullif(raw, F.lit("")), schema).alias("_j"))
    arr = F.col("_j")
    for p in path:
        arr = arr[p]
    return parsed.select(key, F.posexplode(arr).alias("pos", "item")).select(key, F.col("pos").cast("bigint").alias("pos"), "item.*")


def explode_playlist(df: DataFrame, text: str, base_url: str, key: str = "page_id") -> DataFrame:
    """Playlist text → ordered absolute segment URLs and local names
    ``{i:05d}.ts`` (G4); for a master list (``#EXT-X-STREAM-INF``) the first
    variant URL, the media list to fetch next.  A playlist is one row, so
    everything happens inside the row: no shuffle."""
    # lines as splitlines() gives them; a non-empty line that is not a tag
    # is a URI (a whitespace-only line resolves to the base, like urljoin)
    uris = F.transform(F.filter(F.split(F.col(text), r"\r\n|\r|\n"), lambda l: (l != "") & ~l.startswith("#")),
                       lambda l: strip(l))
    is_master = F.col(text).contains("#EXT-X-STREAM-INF")
    media = df.where(~is_master).select(key, base_url, F.posexplode(uris).alias("seg_idx", "_uri"))
    seg = media.select(key, F.col("seg_idx").cast("bigint").alias("seg_idx"),
                       urls.join_url(F.col(base_url), F.col("_uri")).alias("seg_url"),
                       F.format_string("%05d.ts", F.col("seg_idx")).alias("local_name"),
                       F.lit("segment").alias("kind"))
    first = F.try_element_at(uris, F.lit(1))
    master = df.where(is_master & first.isNotNull()).select(
        key, F.lit(0).cast("bigint").alias("seg_idx"), urls.join_url(F.col(base_url), first).alias("seg_url"),
        F.lit(None).cast("string").alias("local_name"), F.lit("variant").alias("kind"))
    return seg.unionByName(master)
