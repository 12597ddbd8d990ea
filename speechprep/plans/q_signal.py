"""Signal queries over the v_blocks waveform fixture.

v_blocks: clips of 64-sample blocks (H = 64, W = 256).  Float outputs are
cast to DOUBLE and rounded to 6 decimals in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..operators import segments as seg
from ..operators import signal as sig
from .registry import query

H, W = 64, 256
PEAK = 0.3  # a block is "voiced" when its peak magnitude reaches this


def _samples(df, cols, arr, idx="sample_idx", val="value"):
    return df.select(*cols, F.posexplode(arr).alias(idx, val)).withColumn(idx, F.col(idx).cast("bigint"))


# ------------------------------------------------------------------- E1
@query("downmix_mono", ["v_blocks"], """
WITH b AS (SELECT clip_id, block_idx // 2 AS k, block_idx % 2 AS ch, samples FROM v_blocks),
s AS (SELECT clip_id, k, ch, unnest(samples) AS x, generate_subscripts(samples, 1) - 1 AS i FROM b)
SELECT a.clip_id, CAST(a.k AS BIGINT) AS block_idx, CAST(a.i AS BIGINT) AS sample_idx,
       round((CAST(a.x AS DOUBLE) + CAST(c.x AS DOUBLE)) / 2, 6) AS value
FROM s a JOIN s c ON a.clip_id = c.clip_id AND a.k = c.k AND a.i = c.i AND a.ch = 0 AND c.ch = 1
""")
def downmix_mono(t: Tables):
    # stereo fixture: even blocks are channel 0, odd blocks channel 1
    b = t.v_blocks
    st = b.groupBy("clip_id", F.floor(F.col("block_idx") / 2).cast("bigint").alias("block_idx")).agg(
        F.first(F.when(F.col("block_idx") % 2 == 0, F.col("samples")), ignorenulls=True).alias("c0"),
        F.first(F.when(F.col("block_idx") % 2 == 1, F.col("samples")), ignorenulls=True).alias("c1"),
    ).where(F.col("c0").isNotNull() & F.col("c1").isNotNull())
    mono = st.select("clip_id", "block_idx", sig.downmix_mono(F.array("c0", "c1")).alias("mono"))
    out = _samples(mono, ["clip_id", "block_idx"], F.col("mono"))
    return out.withColumn("value", F.round("value", 6))


# ------------------------------------------------------------------- E2
@query("pcm16_quantize", ["v_blocks"], """
WITH s AS (SELECT clip_id, block_idx, unnest(samples) AS x, generate_subscripts(samples, 1) - 1 AS i FROM v_blocks)
SELECT clip_id, block_idx, CAST(i AS BIGINT) AS sample_idx,
       CAST(trunc(greatest(least(CAST(x AS FLOAT), CAST(1 AS FLOAT)), CAST(-1 AS FLOAT)) * CAST(32767 AS FLOAT)) AS SMALLINT) AS pcm
FROM s
""")
def pcm16_quantize(t: Tables):
    q = t.v_blocks.select("clip_id", "block_idx", sig.pcm16(F.col("samples")).alias("pcm16"))
    return _samples(q, ["clip_id", "block_idx"], F.col("pcm16"), val="pcm")


# ------------------------------------------------------------------- E3
@query("frame_blocks", ["v_blocks"], """
WITH n AS (SELECT clip_id, count(*) AS nb FROM v_blocks GROUP BY clip_id),
s AS (SELECT clip_id, block_idx, unnest(samples) AS x, generate_subscripts(samples, 1) - 1 AS i FROM v_blocks)
SELECT s.clip_id, CAST(s.block_idx // 4 AS BIGINT) AS frame_idx, CAST((s.block_idx % 4) * 64 + s.i AS BIGINT) AS sample_idx,
       round(CAST(s.x AS DOUBLE), 6) AS value
FROM s JOIN n ON s.clip_id = n.clip_id WHERE s.block_idx // 4 < n.nb // 4
""")
def frame_blocks(t: Tables):
    frames = sig.frame_blocks(t.v_blocks, H, 4 * H)
    out = _samples(frames, ["clip_id", "frame_idx"], F.col("samples"))
    return out.withColumn("value", F.round(F.col("value").cast("double"), 6))


# ------------------------------------------------------------------- E4
_RMS_SQL = """
ss AS (SELECT clip_id, block_idx, list_sum(list_transform(samples, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS e,
              len(samples) AS n FROM v_blocks),
ln AS (SELECT clip_id, sum(n) AS len FROM ss GROUP BY clip_id),
fr AS (SELECT clip_id, unnest(generate_series(0, CAST(floor(len / 64) AS BIGINT))) AS frame_idx FROM ln),
rms AS (SELECT fr.clip_id, CAST(fr.frame_idx AS BIGINT) AS frame_idx, sqrt(sum(ss.e) / 256.0) AS rms
        FROM fr JOIN ss ON fr.clip_id = ss.clip_id AND ss.block_idx BETWEEN fr.frame_idx - 2 AND fr.frame_idx + 1
        GROUP BY fr.clip_id, fr.frame_idx)
"""


@query("frame_rms", ["v_blocks"], "WITH " + _RMS_SQL + "SELECT clip_id, frame_idx, round(rms, 6) AS rms FROM rms")
def frame_rms(t: Tables):
    return sig.frame_rms(t.v_blocks, H, W, block_len=H).withColumn("rms", F.round("rms", 6))


# ------------------------------------------------------------------- E5
# The 64-sample blocks of the fixture are unit vectors, so RMS over whole
# blocks is flat; frames of hop 16 / window 64 straddle blocks and vary.
SL_H, SL_W = 16, 64
SL = dict(threshold=0.122, min_length=20, min_interval=2, max_sil_kept=2)


def _lengths(t: Tables):
    return t.v_blocks.groupBy("clip_id").agg(F.sum(F.size("samples")).cast("bigint").alias("n_samples"))


_SLICE_SQL = f"""
WITH RECURSIVE
smp AS (SELECT clip_id, block_idx * 64 + generate_subscripts(samples, 1) - 1 AS t,
               unnest(samples) AS x FROM v_blocks),
len AS (SELECT clip_id, count(*) AS n FROM smp GROUP BY clip_id),
fr AS (SELECT clip_id, n, unnest(generate_series(0, n // {SL_H})) AS f FROM len),
rms AS (SELECT fr.clip_id, fr.f, sqrt(sum(CAST(smp.x AS DOUBLE) * CAST(smp.x AS DOUBLE)) / {SL_W}.0) AS rms
        FROM fr JOIN smp ON fr.clip_id = smp.clip_id
         AND smp.t >= fr.f * {SL_H} - {SL_W // 2} AND smp.t < fr.f * {SL_H} - {SL_W // 2} + {SL_W}
        GROUP BY fr.clip_id, fr.f),
tot AS (SELECT len.clip_id, len.n, count(*) AS total FROM len JOIN rms ON len.clip_id = rms.clip_id GROUP BY len.clip_id, len.n),
sil AS (SELECT clip_id, f, rms, f - row_number() OVER (PARTITION BY clip_id ORDER BY f) AS grp
        FROM rms WHERE rms < {SL['threshold']}),
bnd AS (SELECT clip_id, grp, min(f) AS s, max(f) + 1 AS i FROM sil GROUP BY clip_id, grp),
runs AS (SELECT b.clip_id, b.s, b.i, t.total,
                row_number() OVER (PARTITION BY b.clip_id ORDER BY b.s) AS k,
                min(struct_pack(r := sil.rms, f := sil.f)).f AS a,
                min(struct_pack(r := sil.rms, f := sil.f)) FILTER (WHERE sil.f >= b.i - {SL['max_sil_kept']}
                    AND sil.f <= least(b.s + {SL['max_sil_kept']}, least(b.i, t.total) - 1)).f AS b,
                min(struct_pack(r := sil.rms, f := sil.f)) FILTER (WHERE sil.f <= least(b.s + {SL['max_sil_kept']},
                    least(b.i, t.total) - 1)).f AS l,
                min(struct_pack(r := sil.rms, f := sil.f)) FILTER (WHERE sil.f >= greatest(b.i - {SL['max_sil_kept']}, b.s)).f AS r,
                min(struct_pack(r := sil.rms, f := sil.f)) FILTER (WHERE sil.f <= least(t.total - 1,
                    b.s + {SL['max_sil_kept']})).f AS tt
         FROM bnd b JOIN sil ON b.clip_id = sil.clip_id AND b.grp = sil.grp JOIN tot t ON b.clip_id = t.clip_id
         GROUP BY b.clip_id, b.grp, b.s, b.i, t.total),
dec AS (SELECT *,
          CASE WHEN i >= total THEN 'trail'
               WHEN (s = 0 AND i > {SL['max_sil_kept']}) OR (i - s >= {SL['min_interval']}) THEN 'check' ELSE 'skip' END AS kind
        FROM runs),
fold(clip_id, k, cs, tb, te) AS (
  SELECT clip_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM tot
  UNION ALL
  SELECT d.clip_id, d.k, c.new_cs, c.tb, c.te
  FROM fold p JOIN dec d ON d.clip_id = p.clip_id AND d.k = p.k + 1,
  LATERAL (SELECT
      CASE WHEN d.kind = 'trail' THEN (CASE WHEN d.total - d.s >= {SL['min_interval']} THEN d.tt END)
           WHEN NOT ((d.s = 0 AND d.i > {SL['max_sil_kept']})
                     OR (d.i - d.s >= {SL['min_interval']} AND d.i - p.cs >= {SL['min_length']})) THEN NULL
           WHEN d.i - d.s <= {SL['max_sil_kept']} THEN (CASE WHEN d.s = 0 THEN 0 ELSE d.a END)
           WHEN d.i - d.s <= 2 * {SL['max_sil_kept']} THEN (CASE WHEN d.s = 0 THEN 0 ELSE least(d.l, d.b) END)
           ELSE (CASE WHEN d.s = 0 THEN 0 ELSE d.l END) END AS tb,
      CASE WHEN d.kind = 'trail' THEN (CASE WHEN d.total - d.s >= {SL['min_interval']} THEN d.total + 1 END)
           WHEN NOT ((d.s = 0 AND d.i > {SL['max_sil_kept']})
                     OR (d.i - d.s >= {SL['min_interval']} AND d.i - p.cs >= {SL['min_length']})) THEN NULL
           WHEN d.i - d.s <= {SL['max_sil_kept']} THEN d.a
           WHEN d.i - d.s <= 2 * {SL['max_sil_kept']} THEN (CASE WHEN d.s = 0 THEN d.r ELSE greatest(d.r, d.b) END)
           ELSE d.r END AS te,
      CASE WHEN d.kind = 'trail' THEN p.cs
           WHEN NOT ((d.s = 0 AND d.i > {SL['max_sil_kept']})
                     OR (d.i - d.s >= {SL['min_interval']} AND d.i - p.cs >= {SL['min_length']})) THEN p.cs
           WHEN d.i - d.s <= {SL['max_sil_kept']} THEN d.a
           WHEN d.i - d.s <= 2 * {SL['max_sil_kept']} THEN (CASE WHEN d.s = 0 THEN d.r ELSE greatest(d.r, d.b) END)
           ELSE d.r END AS new_cs) c
),
tags AS (SELECT clip_id, k, tb, te, lead(tb) OVER (PARTITION BY clip_id ORDER BY k) AS next_b,
                row_number() OVER (PARTITION BY clip_id ORDER BY k) AS j,
                count(*) OVER (PARTITION BY clip_id) AS m
         FROM fold WHERE tb IS NOT NULL),
ch AS (SELECT clip_id, 0 AS ord, CAST(0 AS BIGINT) AS b, tb AS e FROM tags WHERE j = 1 AND tb > 0
       UNION ALL SELECT clip_id, j, te, next_b FROM tags WHERE j < m
       UNION ALL SELECT t.clip_id, m, te, o.total FROM tags t JOIN tot o ON t.clip_id = o.clip_id
                 WHERE j = m AND te < o.total
       UNION ALL SELECT o.clip_id, 0, 0, o.total FROM tot o
                 WHERE NOT EXISTS (SELECT 1 FROM tags t WHERE t.clip_id = o.clip_id)),
res AS (SELECT c.clip_id, c.ord, CAST(c.b * {SL_H} AS BIGINT) AS start_sample,
               CAST(least(o.n, c.e * {SL_H}) AS BIGINT) AS end_sample
        FROM ch c JOIN tot o ON c.clip_id = o.clip_id
        WHERE CAST(ceil(o.n / {SL_H}.0) AS BIGINT) > {SL['min_length']}
        UNION ALL SELECT clip_id, 0, 0, n FROM tot WHERE CAST(ceil(n / {SL_H}.0) AS BIGINT) <= {SL['min_length']})
SELECT clip_id, CAST(row_number() OVER (PARTITION BY clip_id ORDER BY ord) - 1 AS BIGINT) AS chunk_idx,
       start_sample, end_sample FROM res
"""


@query("silence_slice", ["v_blocks"], _SLICE_SQL)
def silence_slice(t: Tables):
    rms = sig.frame_rms(t.v_blocks, SL_H, SL_W, block_len=H)
    return sig.silence_slice(rms, _lengths(t), SL_H, **SL)


# ------------------------------------------------------------------ E10
_PEAK_VAD_SQL = f"""
vv AS (SELECT clip_id, block_idx AS frame_idx, list_max(list_transform(samples, lambda x: abs(x))) >= {PEAK} AS voiced
       FROM v_blocks),
tot AS (SELECT clip_id, max(frame_idx) + 1 AS total FROM vv GROUP BY clip_id),
v AS (SELECT clip_id, frame_idx, lag(frame_idx) OVER (PARTITION BY clip_id ORDER BY frame_idx) AS prev FROM vv WHERE voiced),
i AS (SELECT clip_id, frame_idx,
             sum(CASE WHEN prev IS NULL OR frame_idx - prev - 1 >= 2 THEN 1 ELSE 0 END)
               OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM v),
g AS (SELECT clip_id, island, min(frame_idx) AS s, max(frame_idx) AS last FROM i GROUP BY clip_id, island),
e AS (SELECT g.clip_id, g.island, g.s, t.total,
             CASE WHEN g.island = max(g.island) OVER (PARTITION BY g.clip_id) AND t.total - 1 - g.last < 2
                  THEN t.total - 1 ELSE g.last END AS e
      FROM g JOIN tot t ON g.clip_id = t.clip_id),
k AS (SELECT clip_id, CAST(greatest(0, s - 1) * 64 AS BIGINT) AS start_sample,
             CAST(least(total, e + 1 + 1) * 64 AS BIGINT) AS end_sample FROM e WHERE e - s + 1 >= 2),
segs AS (SELECT clip_id, start_sample, end_sample,
                CAST(row_number() OVER (PARTITION BY clip_id ORDER BY start_sample) - 1 AS BIGINT) AS seg_idx FROM k)
"""


@query("slice_waveform", ["v_blocks"], "WITH " + _PEAK_VAD_SQL + """,
s AS (SELECT clip_id, block_idx, unnest(samples) AS x, generate_subscripts(samples, 1) - 1 AS i FROM v_blocks)
SELECT segs.clip_id, segs.seg_idx, CAST(s.block_idx * 64 + s.i AS BIGINT) AS sample_idx, round(CAST(s.x AS DOUBLE), 6) AS value
FROM segs JOIN s ON segs.clip_id = s.clip_id
  AND s.block_idx * 64 + s.i >= segs.start_sample AND s.block_idx * 64 + s.i < segs.end_sample
""")
def slice_waveform(t: Tables):
    b = t.v_blocks
    frames = b.select("clip_id", F.col("block_idx").alias("frame_idx"),
                      (F.array_max(F.transform("samples", lambda x: F.abs(x))) >= F.lit(PEAK)).alias("voiced"))
    segs = seg.vad_segments(frames, min_silence=2, min_speech=2, pad=1, hop=H)
    out = seg.slice_waveform(segs, b, H)
    return out.withColumn("value", F.round(F.col("value").cast("double"), 6))
