"""Segment queries (E6-E9, B5) over the v_voiced / v_segments fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..operators import segments as seg
from .registry import query

# v_voiced uses small frame constants (FIXTURES.md): min_silence 2,
# min_speech 2, pad 1; hop stays 256.
VAD_ARGS = dict(min_silence=2, min_speech=2, pad=1, hop=256)
# Production merge/split values of the slicer stage (ms).
MERGE_ARGS = dict(target=15000, max_len=60000, strict_gap=200, loose_gap=1500)
SPLIT_ARGS = dict(target=15000, max_len=20000, tail=3000)
SR = 16000

_VAD_SQL = """
WITH tot AS (SELECT clip_id, max(frame_idx) + 1 AS total FROM v_voiced GROUP BY clip_id),
v AS (SELECT clip_id, frame_idx, lag(frame_idx) OVER (PARTITION BY clip_id ORDER BY frame_idx) AS prev
      FROM v_voiced WHERE voiced),
i AS (SELECT clip_id, frame_idx,
             sum(CASE WHEN prev IS NULL OR frame_idx - prev - 1 >= 2 THEN 1 ELSE 0 END)
               OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM v),
g AS (SELECT clip_id, island, min(frame_idx) AS s, max(frame_idx) AS last FROM i GROUP BY clip_id, island),
e AS (SELECT g.clip_id, g.island, g.s, t.total,
             CASE WHEN g.island = max(g.island) OVER (PARTITION BY g.clip_id) AND t.total - 1 - g.last < 2
                  THEN t.total - 1 ELSE g.last END AS e
      FROM g JOIN tot t ON g.clip_id = t.clip_id),
k AS (SELECT clip_id, CAST(greatest(0, s - 1) * 256 AS BIGINT) AS start_sample,
             CAST(least(total, e + 1 + 1) * 256 AS BIGINT) AS end_sample FROM e WHERE e - s + 1 >= 2)
SELECT clip_id, start_sample, end_sample,
       CAST(row_number() OVER (PARTITION BY clip_id ORDER BY start_sample) - 1 AS BIGINT) AS seg_idx
FROM k
"""


@query("vad_segments", ["v_voiced"], _VAD_SQL)
def vad_segments(t: Tables):
    return seg.vad_segments(t.v_voiced, **VAD_ARGS)


# Greedy merge as a recursive CTE: the state (cs, ce) after each segment;
# a merged segment is the max end reached from one start.
_MERGE_CTES = """
s AS (SELECT clip_id, start_ms, end_ms,
             row_number() OVER (PARTITION BY clip_id ORDER BY start_ms) AS rn FROM v_segments),
r AS (SELECT clip_id, rn, start_ms AS cs, end_ms AS ce FROM s WHERE rn = 1
      UNION ALL
      SELECT s.clip_id, s.rn,
             CASE WHEN s.end_ms - r.cs <= 60000
                       AND ((r.ce - r.cs < 15000 AND s.start_ms - r.ce < 1500) OR s.start_ms - r.ce < 200)
                  THEN r.cs ELSE s.start_ms END,
             s.end_ms
      FROM r JOIN s ON s.clip_id = r.clip_id AND s.rn = r.rn + 1),
m AS (SELECT clip_id, CAST(cs AS BIGINT) AS start_ms, CAST(max(ce) AS BIGINT) AS end_ms FROM r GROUP BY clip_id, cs)
"""

_SPLIT_CTES = _MERGE_CTES + """,
n AS (SELECT *, CASE WHEN end_ms - start_ms <= 20000 THEN 1
                     WHEN end_ms - start_ms >= 18000 THEN 1 + CAST(floor((end_ms - start_ms - 18000) / 15000) AS BIGINT)
                     ELSE 1 END AS n FROM m),
p0 AS (SELECT clip_id, start_ms AS s0, end_ms AS e0, n, unnest(generate_series(0, n - 1)) AS piece_no FROM n),
p AS (SELECT clip_id, CAST(piece_no AS INTEGER) AS piece_no, CAST(s0 + piece_no * 15000 AS BIGINT) AS start_ms,
             CAST(CASE WHEN piece_no = n - 1 THEN e0 ELSE s0 + (piece_no + 1) * 15000 END AS BIGINT) AS end_ms
      FROM p0)
"""

_DROP_CTES = _SPLIT_CTES + """,
d AS (SELECT clip_id, start_ms, end_ms,
             CAST(row_number() OVER (PARTITION BY clip_id ORDER BY start_ms) - 1 AS BIGINT) AS piece_idx FROM p)
"""


@query("merge_segments", ["v_segments"], "WITH RECURSIVE " + _MERGE_CTES + "SELECT clip_id, start_ms, end_ms FROM m")
def merge_segments(t: Tables):
    return seg.merge_segments(t.v_segments, **MERGE_ARGS)


@query("split_long_segments", ["v_segments"],
       "WITH RECURSIVE " + _SPLIT_CTES + "SELECT clip_id, piece_no, start_ms, end_ms FROM p")
def split_long_segments(t: Tables):
    merged = seg.merge_segments(t.v_segments, **MERGE_ARGS)
    return seg.split_long_segments(merged, **SPLIT_ARGS).select("clip_id", "piece_no", "start_ms", "end_ms")


@query("drop_tiny_segments", ["v_segments"],
       "WITH RECURSIVE " + _DROP_CTES + "SELECT clip_id, piece_idx, start_ms, end_ms FROM d WHERE end_ms - start_ms >= 1500")
def drop_tiny_segments(t: Tables):
    merged = seg.merge_segments(t.v_segments, **MERGE_ARGS)
    pieces = seg.split_long_segments(merged, **SPLIT_ARGS)
    return seg.number_and_drop_tiny(pieces).select("clip_id", "piece_idx", "start_ms", "end_ms")


def _chain(t: Tables):
    raw = t.v_segments
    total = raw.groupBy("clip_id").agg(F.floor(F.max("end_ms") * F.lit(SR) / F.lit(1000)).cast("bigint").alias("total_samples"))
    merged = seg.merge_segments(raw, **MERGE_ARGS)
    pieces = seg.number_and_drop_tiny(seg.split_long_segments(merged, **SPLIT_ARGS))
    pieces = pieces.join(total, on="clip_id")
    out = seg.slice_bounds(pieces, F.col("total_samples"), SR,
                           F.concat(F.lit("clip"), F.col("clip_id").cast("string")), F.lit(".wav"))
    return out.select("clip_id", "piece_idx", "start_ms", "end_ms", "start_sample", "end_sample", "out_name")


_CHAIN_SQL = "WITH RECURSIVE " + _DROP_CTES + """,
tot AS (SELECT clip_id, CAST(floor(max(end_ms) * 16000 / 1000) AS BIGINT) AS total_samples FROM v_segments GROUP BY clip_id)
SELECT d.clip_id, d.piece_idx, d.start_ms, d.end_ms,
       greatest(0, CAST(floor(d.start_ms * 16000 / 1000) AS BIGINT)) AS start_sample,
       least(tot.total_samples, CAST(floor(d.end_ms * 16000 / 1000) AS BIGINT)) AS end_sample,
       printf('%s_%03d%s', 'clip' || CAST(d.clip_id AS VARCHAR), d.piece_idx, '.wav') AS out_name
FROM d JOIN tot ON d.clip_id = tot.clip_id
WHERE d.end_ms - d.start_ms >= 1500
"""


@query("slice_bounds", ["v_segments"], _CHAIN_SQL)
def slice_bounds(t: Tables):
    return _chain(t)


@query("segment_chain", ["v_segments"], _CHAIN_SQL)
def segment_chain(t: Tables):
    return _chain(t)
