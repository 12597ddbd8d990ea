"""Packing queries over the v_files queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..operators import batching, packing
from .registry import query

MAX_BYTES = 100_000_000          # FIXTURES.md: max 100000000 bytes
NOW = "2001-08-01 00:00:00"      # fixed "now" so results are reproducible
STALE_S = 30 * 86400             # stale threshold in days for this fixture
PART_BYTES = 10 * 1024 ** 3      # archive split size (10 GiB parts)

# Next-fit as a recursive CTE: state (seq, open bytes, closed) after each file.
_PACK_CTES = """
f AS (SELECT bucket, name, bytes, mtime,
             row_number() OVER (PARTITION BY bucket ORDER BY mtime, name) AS rn FROM v_files),
r AS (SELECT bucket, rn, name, CAST(0 AS BIGINT) AS seq, bytes AS cur, bytes >= {max} AS closed FROM f WHERE rn = 1
      UNION ALL
      SELECT f.bucket, f.rn, f.name,
             CASE WHEN r.closed OR r.cur + f.bytes > {max} THEN r.seq + 1 ELSE r.seq END,
             CASE WHEN r.closed OR r.cur + f.bytes > {max} THEN f.bytes ELSE r.cur + f.bytes END,
             (CASE WHEN r.closed OR r.cur + f.bytes > {max} THEN f.bytes ELSE r.cur + f.bytes END) >= {max}
      FROM r JOIN f ON f.bucket = r.bucket AND f.rn = r.rn + 1),
last AS (SELECT bucket, max(rn) AS last_rn FROM f GROUP BY bucket),
tail AS (SELECT r.bucket, r.seq FROM r JOIN last ON r.bucket = last.bucket AND r.rn = last.last_rn WHERE NOT r.closed),
tail_age AS (SELECT f.bucket, max(epoch(TIMESTAMP '{now}') - epoch(f.mtime)) AS oldest_age
             FROM f JOIN r ON f.bucket = r.bucket AND f.rn = r.rn JOIN tail ON r.bucket = tail.bucket AND r.seq = tail.seq
             GROUP BY f.bucket),
packed AS (SELECT f.bucket, f.name, f.bytes, f.mtime, r.seq AS volume_seq,
                  CASE WHEN tail.seq IS NOT NULL AND r.seq = tail.seq AND tail_age.oldest_age < {stale}
                       THEN 'waiting' ELSE 'packed' END AS status
           FROM f JOIN r ON f.bucket = r.bucket AND f.rn = r.rn
           LEFT JOIN tail ON f.bucket = tail.bucket LEFT JOIN tail_age ON f.bucket = tail_age.bucket)
""".format(max=MAX_BYTES, now=NOW, stale=STALE_S)


def _packed(t: Tables):
    return packing.pack_volumes(t.v_files, MAX_BYTES, NOW, STALE_S)


@query("pack_volumes", ["v_files"], "WITH RECURSIVE " + _PACK_CTES +
       "SELECT bucket, name, bytes, volume_seq, status FROM packed")
def pack_volumes(t: Tables):
    return _packed(t).select("bucket", "name", "bytes", "volume_seq", "status")


@query("partitioned_export", ["v_files"], "WITH RECURSIVE " + _PACK_CTES + """
SELECT bucket, volume_seq, printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq) AS volume_name,
       split_part(printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq), '_', 1) AS lang,
       'volumes/' || split_part(printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq), '_', 1) || '/' ||
         printf('%s_%s_%03d.tar', bucket, '20010801_000000', volume_seq) AS object_key,
       COUNT(*) AS n_files, CAST(SUM(bytes) AS BIGINT) AS bytes
FROM packed WHERE status = 'packed' GROUP BY bucket, volume_seq
""")
def partitioned_export(t: Tables):
    return packing.volume_manifest(_packed(t), NOW, prefix="volumes/")


@query("oldest_wait", ["v_files"], "WITH RECURSIVE " + _PACK_CTES + f"""
SELECT bucket, min(mtime) AS oldest_mtime, COUNT(*) AS n_files,
       CAST(epoch(TIMESTAMP '{NOW}') - epoch(min(mtime)) AS BIGINT) AS age_s,
       CAST(greatest(0, {STALE_S} - (epoch(TIMESTAMP '{NOW}') - epoch(min(mtime)))) AS DOUBLE) / 60 AS minutes_left
FROM packed WHERE status = 'waiting' GROUP BY bucket
""")
def oldest_wait(t: Tables):
    # what packing left waiting in each bucket
    waiting = packing.pack_volumes(t.v_files, MAX_BYTES, NOW, STALE_S).where("status = 'waiting'")
    return batching.oldest_wait(waiting, "bucket", "mtime", F.lit(NOW).cast("timestamp_ntz"), STALE_S)


@query("volume_byte_ranges", ["v_files"], f"""
SELECT bucket, name, "offset", part_no FROM (
  SELECT bucket, name, "offset", unnest(generate_series(CAST(floor("offset" / {PART_BYTES}) AS BIGINT),
                                         CAST(floor(greatest("offset" + bytes - 1, "offset") / {PART_BYTES}) AS BIGINT))) AS part_no
  FROM (SELECT bucket, name, bytes,
               CAST(SUM(bytes) OVER (PARTITION BY bucket ORDER BY mtime, name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - bytes AS BIGINT) AS "offset"
        FROM v_files) o) p
""")
def volume_byte_ranges(t: Tables):
    return batching.volume_byte_ranges(t.v_files, "bucket", ["mtime", "name"], "bytes", PART_BYTES) \
        .select("bucket", "name", "offset", "part_no")


@query("latest_n", ["v_files"], """
SELECT bucket, name, mtime, rank FROM (
  SELECT bucket, name, mtime, CAST(row_number() OVER (PARTITION BY bucket ORDER BY mtime DESC, name) AS INTEGER) AS rank
  FROM v_files) r WHERE rank <= 5
""")
def latest_n(t: Tables):
    return batching.latest_n(t.v_files, "bucket", [F.col("mtime").desc(), F.col("name")], 5) \
        .select("bucket", "name", "mtime", "rank")
