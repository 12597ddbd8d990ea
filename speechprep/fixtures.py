"""Test fixtures: derived views over the driver's tables.

The driver ships generic tables (documents, events, orders, ...).  These
views give them the shapes the speech-prep operators read (file catalogs,
VAD segments, frame flags, waveform blocks, file queues, ...).  Each view
is one SQL text that runs unchanged in Spark and in DuckDB, so the oracle
compares *operators*, never two hand-written copies of a fixture.

In Spark a view is built lazily with ``spark.sql(text, name=DataFrame)``
(no global temp views, so several scale factors can coexist in one
session); for DuckDB the same text is emitted as a ``WITH`` clause.
Literal braces are doubled because the text is a ``str.format`` template.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# name -> (dependencies, template)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, deps: tuple[str, ...], text: str) -> None:
    VIEWS[name] = (deps, text.strip())


_view("v_audio", ("documents",), """
SELECT doc_id,
       'data/' || source || '/sliced/' || lpad(CAST(doc_id AS STRING), 6, '0') || '.' || ext AS path,
       source AS album, ext, lang, n_chars * 1000 AS bytes,
       CASE WHEN doc_id % 17 = 0 THEN NULL
            WHEN doc_id % 17 = 1 THEN CAST(30000 AS BIGINT)
            ELSE n_chars * 20 END AS duration_ms
FROM (SELECT *, CASE doc_id % 5 WHEN 0 THEN 'wav' WHEN 1 THEN 'mp3' WHEN 2 THEN 'flac'
                                WHEN 3 THEN 'OPUS' ELSE 'txt' END AS ext FROM {documents}) d
""")

_view("v_done", ("v_audio", "labels"), """
SELECT a.path, l.quality, l.toxic FROM {v_audio} a JOIN {labels} l ON a.doc_id = l.doc_id
""")

_view("v_old", ("v_audio", "documents"), """
SELECT a.path, d.text FROM {v_audio} a JOIN {documents} d ON a.doc_id = d.doc_id WHERE a.doc_id % 3 <> 0
""")

_view("v_new", ("v_audio",), """
SELECT a.path, 'new ' || CAST(a.doc_id AS STRING) AS text FROM {v_audio} a WHERE a.doc_id % 2 = 0
""")

_view("v_description", ("v_audio", "benchmark"), """
SELECT a.path, b.text AS description FROM {v_audio} a JOIN {benchmark} b ON a.doc_id = b.item_id
""")

_view("v_segments", ("events",), """
SELECT clip_id, seg_no, start_ms, start_ms + dur_ms AS end_ms FROM (
  SELECT clip_id, dur_ms, CAST(row_number() OVER w - 1 AS BIGINT) AS seg_no,
         CAST(coalesce(sum(dur_ms + gap_ms) OVER (PARTITION BY clip_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms
  FROM (SELECT user_id AS clip_id, ts, event_id, CAST(floor(value * 100) AS BIGINT) + 1 AS dur_ms,
               (event_id * 37) % 3000 AS gap_ms FROM {events}) e
  WINDOW w AS (PARTITION BY clip_id ORDER BY ts, event_id)) s
""")

_view("v_voiced", ("events",), """
SELECT user_id AS clip_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_idx,
       event_type IN ('view', 'click') AS voiced
FROM {events}
""")

_view("v_blocks", ("embeddings",), """
SELECT label AS clip_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS block_idx,
       embedding AS samples
FROM {embeddings}
""")

_view("v_files", ("orders",), """
SELECT o_orderpriority AS bucket, 'f' || lpad(CAST(o_orderkey AS STRING), 9, '0') || '.wav' AS name,
       CAST(floor(o_totalprice * 100) AS BIGINT) AS bytes, o_orderdate AS mtime
FROM {orders}
""")

_view("v_chunks", ("events",), """
SELECT user_id AS request_id, rn AS arrival, CASE WHEN rn = n THEN -rn ELSE rn END AS sequence, event_type AS payload
FROM (SELECT user_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS rn,
             CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS n FROM {events}) c
""")

# every line of the text is a lyric line, and every word of it is stamped
_view("v_lyrics", ("documents",), """
SELECT doc_id AS song_id,
       CASE WHEN doc_id % 4 = 0 THEN '' ELSE '[00:' || ss || '.260]' ||
       replace(replace(text, chr(10), chr(10) || '[01:' || ss || '.150]'), ' ', '[00:' || ss || '.94]') END AS yrc,
       '[ti: ' || source || ']' || chr(10) || '[ar: ' || lang || ']' || chr(10) ||
       CASE WHEN doc_id % 8 = 0 THEN 'plain' ELSE '[00:01.00]' || replace(text, chr(10), chr(10) || '[00:02.00]') END AS lrc
FROM (SELECT *, lpad(CAST(doc_id % 60 AS STRING), 2, '0') AS ss FROM {documents}) d
""")

_view("v_catalog", ("supplier",), """
SELECT s_suppkey % 3 AS source_id, CAST(row_number() OVER (PARTITION BY s_suppkey % 3 ORDER BY s_suppkey) AS BIGINT) AS page_no,
       '{{"data":{{"programs":[{{"id":' || CAST(s_suppkey * 10 AS STRING) || ',"title":"' || s_name || '/a"}}' ||
       CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE ',{{"id":' || CAST(s_suppkey * 10 + 1 AS STRING) || ',"title":"' || s_name || '/b"}}' END ||
       ']}}}}' AS payload
FROM {supplier}
""")

_view("v_names", ("documents",), """
SELECT doc_id, source AS album, text || CASE doc_id % 3 WHEN 0 THEN ' a/b: "c"?' WHEN 1 THEN '  x|y.v2.mp3' ELSE '' END AS title,
       CASE doc_id % 6 WHEN 0 THEN lang || '-XX' WHEN 1 THEN 'English' WHEN 2 THEN 'spa_ES' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE lang END AS lang_tag,
       'https://cdn.example.org/' || source || '/' || CAST(doc_id AS STRING) ||
       CASE doc_id % 4 WHEN 0 THEN '.MP3?sig=1' WHEN 1 THEN '.flac' ELSE '' END AS url,
       CASE doc_id % 4 WHEN 2 THEN 'audio/ogg; codecs=opus' ELSE NULL END AS content_type
FROM {documents}
""")

_view("v_tts", ("part",), """
SELECT p_partkey AS request_id, p_name || CASE WHEN p_partkey % 3 = 0 THEN '.txt' ELSE '' END AS file_name,
       CASE WHEN p_partkey % 7 = 0 THEN 'bad' ELSE CAST(p_size * 10 AS STRING) END AS chunk_length,
       CASE p_partkey % 4 WHEN 0 THEN '64' WHEN 1 THEN '192' WHEN 2 THEN '99' ELSE NULL END AS mp3_bitrate,
       CASE p_partkey % 3 WHEN 0 THEN 'normal' WHEN 1 THEN 'fast' ELSE NULL END AS latency,
       CASE WHEN p_partkey % 2 = 0 THEN 'S_' ELSE 'V_' END || p_brand AS voice
FROM {part}
""")


class Tables:
    """Lazy accessor for base tables and derived views of one scale factor.

    ``Tables(spark, "/root/testdata/sf0.01").v_audio`` is a DataFrame; each
    attribute is built once per instance so self-joins share one plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        from .session import ship_package

        ship_package(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in VIEWS:
                deps, text = VIEWS[name]
                df = self.spark.sql(text, **{d: self.get(d) for d in deps})
            else:
                raise KeyError(name)
            self._cache[name] = df
        return self._cache[name]


def _closure(names: tuple[str, ...] | list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duckdb_with(views: list[str] | tuple[str, ...], select: str) -> str:
    """Oracle text: ``WITH <views in dependency order> <select>``."""
    parts = []
    for name in _closure(views):
        deps, text = VIEWS[name]
        parts.append(f"{name} AS (\n{text.format(**{d: d for d in deps})}\n)")
    body = select.strip()
    if not parts:
        return body
    import re

    m = re.match(r"(?is)^with\s+recursive\s+", body)
    if m:
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + body[m.end():]
    m = re.match(r"(?is)^with\s+", body)
    if m:  # merge the query's own CTEs after the views
        return "WITH " + ",\n".join(parts) + ",\n" + body[m.end():]
    return "WITH " + ",\n".join(parts) + "\n" + body
