"""Operator 11: conversation prefix trie with count-min screening.

Every conversation is rebuilt (see :func:`rebuilt`) and named, turn by turn, by
the digests of its prefixes: 128 bits that add up a hash of each turn's depth
and SHA-256, so that a prefix that lies in several slices of the input can be
summed across them.

A count-min sketch of all prefix digests screens them.  It never counts too
low: an estimate of one proves that a single conversation has this prefix, and
so every longer one.  What lies between the first such prefix and the end of
its conversation is emitted where it stands, as nodes with one member and one
child.  Only the prefixes before (possibly shared), the first proven one and
the end are shuffled, and grouped exactly.  Two bits a cell tell none, one and
more; ``cells`` bounds the sketch (and the one plane that is broadcast to
``2 * cells / 8`` bytes, 32 MB).  A sketch that is too small for its input
proves less, but changes no result.

Sums over subtrees need no recursion: each node is credited to its smallest
member, whose own prefixes are the node's ancestors, so a running sum from the
end of each conversation, added up by prefix, gives every subtree's sum.

No conversation is held whole: rows are cut into ranges of (conversation,
place), and a range's edges (two rows a range at most) carry sums across.  All
groups are summed before they are shuffled; the ids that end at a node are
formatted in ranges, and one task only runs the digest over the finished text.

Defined cases: rows of equal turn are ordered by role, then by the SHA-256 of
their text; repeated rows are turns of their own; rows without a conv_id belong
to no conversation; an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import materialize
from ..session import ship_package
from .common import hot_keys, lookup, pick, table, written

BLOCK, HEADS = 100, 6  # ids that share a first conversation; a head has fewer turns than HEADS
_M = (1 << 64) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def head_length(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % HEADS


def _mix(x: int) -> int:
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _M
    x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & _M
    return x ^ (x >> 32)


def _slices(df: DataFrame, *keys) -> DataFrame:
    """``df`` cut into ranges of ``keys``, sorted, numbered and checkpointed."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return materialize(cut.withColumn("slice", F.spark_partition_id()))


class Edges:
    """What a slice must know of the ones before: of the conversation it starts
    in, the rows before it and their number in all, and the first turns of the
    block's first conversation.  At most some rows a slice."""

    def __init__(self, turns: DataFrame):
        self.first = {r.slice: r.x for r in turns.groupBy("slice").agg(F.min_by(F.struct("base", "conv_id"), "at").alias("x")).collect()}
        convs, bases = ({getattr(x, c) for x in self.first.values()} for c in ("conv_id", "base"))
        found = turns.where(F.col("conv_id").isin(list(convs))).groupBy("conv_id", "slice").count().collect() if convs else []
        self.total: dict[int, int] = {}
        self.before: dict[int, int] = {}
        per: dict[int, list] = {}
        for r in found:
            per.setdefault(r.conv_id, []).append((r.slice, r["count"]))
        for conv, parts in per.items():
            if len(parts) > 1:
                self.total[conv] = sum(n for _, n in parts)
            for s, _ in parts:
                if self.first[s].conv_id == conv:
                    self.before[s] = sum(n for other, n in parts if other < s)
        self.head: dict[int, list] = {}
        if bases:
            order = Window.partitionBy("conv_id").orderBy("slice", "at")
            heads = turns.where((F.col("conv_id") == F.col("base")) & F.col("base").isin(list(bases)))
            heads = heads.withColumn("k", F.row_number().over(order)).where(F.col("k") < HEADS)
            for r in sorted(heads.collect(), key=lambda r: r.k):
                self.head.setdefault(r.base, []).append((r.w1, r.w2, r.chars))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, dict]:
    """(conv_id, depth, p1, p2, chars, last, slice), in order within each
    partition, and the digests before a slice's first conversation.

    Conversation ``c`` is the first ``h`` turns of conversation ``c - c % 100``
    and its own turns after its first ``h``, with ``h`` the CRC-32 of its number
    modulo 6.  ``depth`` 0 stands for the start.  ``p1, p2`` sum the turns of
    this slice; only texts' digests are moved, never the texts."""
    spark = conversations.sparkSession
    ship_package(spark)
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    sha = lambda c: F.unhex(F.sha2(c, 256))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", sha(role).alias("r"), role.alias("role"),
                       sha(text).alias("s"), F.length(text).cast("long").alias("chars"))
    both = F.hex(sha(F.concat("r", "s")))
    word = lambda k: F.conv(F.substring(both, 16 * k + 1, 16), 16, -10).cast("long")
    rows = rows.select((F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"), "conv_id", "turn", "role", "s", "chars",
                       word(0).alias("w1"), word(1).alias("w2"))
    own = F.col("conv_id") != F.col("base")  # the block's first conversation comes first
    # equal rows can't be told apart: a random last key only spreads them
    turns = _slices(rows, F.col("base"), own, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("s"), F.rand(11))
    turns = turns.select("slice", "base", "conv_id", "w1", "w2", "chars").withColumn("at", F.monotonically_increasing_id())
    edges = Edges(turns)

    def run(batches) -> Iterator:
        import pyarrow as pa

        names = ["conv_id", "depth", "p1", "p2", "chars", "last", "slice"]
        types = [pa.int64()] * 5 + [pa.bool_(), pa.int32()]
        out: list[list] = [[] for _ in names]
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        conv = base = None
        head: list[tuple] = []
        depth = rank = p1 = p2 = h = 0
        total = None  # turns of a conversation that lies in several slices

        def put(chars: int, w1: int, w2: int, step: int) -> None:
            nonlocal p1, p2, depth
            if step:
                depth += 1
                p1 = (p1 + _mix((w1 + depth * 0x9E3779B97F4A7C15) & _M)) & _M
                p2 = (p2 + _mix((w2 + depth * 0xC2B2AE3D27D4EB4F) & _M)) & _M
            last = total is not None and depth == length()
            for column, x in zip(out, (conv, depth, signed(p1), signed(p2), chars, last, at)):
                column.append(x)

        def length() -> int:  # of a conversation whose number of turns is known
            return total if conv == base else min(h, len(head)) + max(0, total - h)

        def ready(k: int):
            got = pa.RecordBatch.from_arrays([pa.array(c[:k], t) for c, t in zip(out, types)], names)
            for c in out:
                del c[:k]
            return got

        for b in batches:
            for at, new_base, new, w1, w2, chars in zip(*(b.column(k).to_pylist() for k in range(6))):
                if new != conv:
                    if conv is not None and total is None:
                        out[5][-1] = True  # the row before was its conversation's last
                    start = conv is None and edges.before.get(at, 0)
                    if new_base != base:
                        base, head = new_base, list(edges.head.get(new_base, [])) if conv is None else []
                    conv, rank, depth, p1, p2, h = new, 0, 0, 0, 0, head_length(new)
                    total = edges.total.get(new)
                    if start:  # the conversation goes on
                        rank = start
                        depth = rank if conv == base else min(h, len(head)) + max(0, rank - h)
                    else:
                        put(0, 0, 0, 0)
                        if conv != base:
                            for x in head[:h]:
                                put(x[2], x[0], x[1], 1)
                        elif conv == base:
                            head = []
                rank += 1
                if conv == base:
                    if rank < HEADS and len(head) < rank:
                        head.append((w1, w2, chars))
                    put(chars, w1, w2, 1)
                elif rank > h:
                    put(chars, w1, w2, 1)
            if len(out[0]) > 5000:  # the last row is held until it is known whether it is the last
                yield ready(len(out[0]) - 1)
        if conv is not None and total is None:
            out[5][-1] = True
        if out[0]:
            yield ready(len(out[0]))

    schema = "conv_id long, depth long, p1 long, p2 long, chars long, last boolean, slice int"
    moved = materialize(turns.drop("at").mapInArrow(run, schema))
    before: dict[int, tuple] = {}
    if edges.total:
        parts = moved.where(F.col("conv_id").isin(list(edges.total))).groupBy("conv_id", "slice").agg(
            F.max_by(F.struct("p1", "p2"), "depth").alias("p")).collect()
        for s, x in edges.first.items():
            if edges.before.get(s):
                sums = [r.p for r in parts if r.conv_id == x.conv_id and r.slice < s]
                before[s] = (x.conv_id, sum(p.p1 for p in sums) & _M, sum(p.p2 for p in sums) & _M)
    return moved, before


def _digests(b, before: dict):
    """Prefix digests of a batch, as two uint64 arrays; ``before`` is added to
    the first conversation of each slice."""
    import numpy as np

    conv, p1, p2, s = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 6))
    p1, p2 = p1.astype(np.int64).view(np.uint64).copy(), p2.astype(np.int64).view(np.uint64).copy()
    for k in np.unique(s).tolist():
        if k in before:
            name, x, y = before[k]
            at = (s == k) & (conv == name)
            p1[at] += np.uint64(x)
            p2[at] += np.uint64(y)
    return p1, p2


def sketch(prefixes: DataFrame, before: dict, rows: int, cells: int = 1 << 27, part: int = 1 << 16):
    """Bit planes "more than one" of a two-row count-min sketch of all digests
    (a list of two uint8 arrays), with 8 cells a prefix or ``cells`` if fewer.

    Each task counts into bits for one and more, block by block; blocks are
    merged as they stream by, so no task holds more than one sketch."""
    import numpy as np

    width = min(cells, max(part, 1 << (8 * max(1, rows) - 1).bit_length()))
    each = part // 8  # bytes of a block's plane

    def count(batches) -> Iterator:
        import pyarrow as pa

        one, more = (np.zeros((2, width // 8), np.uint8) for _ in "ab")
        for b in batches:
            keep = b.column(1).to_numpy() > 0
            for k, p in enumerate(_digests(b, before)):
                cell, n = np.unique(p[keep] & np.uint64(width - 1), return_counts=True)
                new, twice = np.zeros(width // 8, np.uint8), np.zeros(width // 8, np.uint8)
                np.bitwise_or.at(new, (cell >> np.uint64(3)).astype(np.int64), (1 << (cell & np.uint64(7))).astype(np.uint8))
                c2 = cell[n > 1]
                np.bitwise_or.at(twice, (c2 >> np.uint64(3)).astype(np.int64), (1 << (c2 & np.uint64(7))).astype(np.uint8))
                more[k] |= twice | (one[k] & new)
                one[k] |= new
        blocks = [(k * (width // part) + j, one[k, j * each:][:each], more[k, j * each:][:each])
                  for k in (0, 1) for j in np.flatnonzero(one[k].reshape(-1, each).any(1)).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _, _ in blocks], pa.int32()),
                                          pa.array([zlib.compress(o.tobytes() + m.tobytes(), 1) for _, o, m in blocks], pa.binary())],
                                         ["block", "bits"])

    def merge(batches) -> Iterator:  # rows come sorted by block
        import pyarrow as pa

        name, one, more = None, None, None
        done: list[tuple] = []
        for b in batches:
            for k, bits in zip(b.column(0).to_pylist(), b.column(1)):
                got = np.frombuffer(zlib.decompress(bits.as_py()), np.uint8)
                if k != name:
                    if name is not None:
                        done.append((name, zlib.compress(more.tobytes(), 1)))
                    name, one, more = k, got[:each].copy(), got[each:].copy()
                else:
                    more |= got[each:] | (one & got[:each])
                    one |= got[:each]
        if name is not None:
            done.append((name, zlib.compress(more.tobytes(), 1)))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int32()), pa.array([x for _, x in done], pa.binary())],
                                         ["block", "bits"])

    kind = "block int, bits binary"
    dealt = prefixes.mapInArrow(count, kind).repartition(F.col("block")).sortWithinPartitions("block")
    planes = np.zeros((2 * width // part, each), np.uint8)
    for r in dealt.mapInArrow(merge, kind).toLocalIterator():
        planes[r.block] = np.frombuffer(zlib.decompress(bytes(r.bits)), np.uint8)
    return planes.reshape(2, -1)


def screened(prefixes: DataFrame, before: dict, planes) -> DataFrame:
    """The rows of ``prefixes`` with ``key`` (their digest) and ``tail``: true for
    those between a conversation's first prefix that the sketch proves to be
    its own and its end."""
    shared = prefixes.sparkSession.sparkContext.broadcast(planes)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        planes, own, proven = shared.value, None, False
        for b in batches:
            p = _digests(b, before)
            seen = []
            for k in (0, 1):
                cell = p[k] & np.uint64(planes.shape[1] * 8 - 1)
                seen.append((planes[k][(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1)
            single = (seen[0] & seen[1]) == 0
            tail = []
            for conv, depth, one, last in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), single.tolist(), b.column(5).to_pylist()):
                if conv != own:
                    own, proven = conv, False
                tail.append(proven and not last)
                proven = proven or (one and depth > 0)
            key = np.stack(p, 1).astype(">u8").tobytes()
            keys = pa.array([key[k:k + 16] for k in range(0, len(key), 16)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), keys, b.column(4), b.column(5), pa.array(tail, pa.bool_())],
                                             ["conv_id", "depth", "key", "chars", "last", "tail"])

    return prefixes.mapInArrow(run, "conv_id long, depth long, key binary, chars long, last boolean, tail boolean")


def _ends(ends: DataFrame, piece: int = 1 << 16) -> DataFrame:
    """key, sha: SHA-256 of the ids of each key, in order, comma-joined.  Ids are
    sorted and formatted in ranges; the task that digests a key reads pieces of
    64 KB of finished text."""

    def text(batches) -> Iterator:
        import pyarrow as pa

        key, first, ids, size = None, 0, [], 0
        out: list[tuple] = []
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key or size > piece:
                    if ids:
                        out.append((key, first, ",".join(ids).encode()))
                    key, first, ids, size = k, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if len(out) > 100:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["key", "first", "ids"])
                out = []
        if ids:
            out.append((key, first, ",".join(ids).encode()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["key", "first", "ids"])

    def digest(batches) -> Iterator:
        import pyarrow as pa

        key, run = None, None
        out: list[tuple] = []
        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), b.column(2)):
                if k != key:
                    if run:
                        out.append((key, run.hexdigest()))
                    key, run = k, hashlib.sha256()
                else:
                    run.update(b",")
                run.update(ids.as_py())
        if run:
            out.append((key, run.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["key", "sha"])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("key"), F.col("conv_id")]
    ranges = ends.select("key", "conv_id").repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    pieces = ranges.mapInArrow(text, "key binary, first long, ids binary").repartition(F.col("key")).sortWithinPartitions("key", "first")
    return pieces.mapInArrow(digest, "key binary, sha string")


def _edges_of(rows: DataFrame) -> DataFrame | None:
    """For conversations that lie in several slices (one a slice's edge at most):
    sums of the slices after, member and kind of the rows beside the cut."""
    parts = rows.groupBy("conv_id", "slice").agg(
        F.sum("saving").alias("saving"), F.sum("leaf").alias("leaf"), F.min_by("named", "depth").alias("named"),
        F.max_by("member", "depth").alias("member"))
    several = [r.conv_id for r in parts.groupBy("conv_id").count().where("count > 1").select("conv_id").collect()]
    if not several:
        return None
    order = Window.partitionBy("conv_id").orderBy("slice")
    rest = order.rowsBetween(1, Window.unboundedFollowing)
    return parts.where(F.col("conv_id").isin(several)).select(
        F.col("conv_id").alias("c"), F.col("slice").alias("s"), F.sum("saving").over(rest).alias("saving_after"),
        F.sum("leaf").over(rest).alias("leaf_after"), F.lead("named").over(order).alias("named_after"),
        F.lag("member").over(order).alias("member_before"))


def trie(conversations: DataFrame, cells: int = 1 << 27) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    prefixes, before = rebuilt(conversations)
    marked = written(screened(prefixes, before, sketch(prefixes, before, prefixes.count(), cells)), "trie-prefixes")
    tails = marked.where("tail").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *[F.lit(1).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves")],
        F.lit(0).cast("long").alias("saved_tokens"), F.lit(EMPTY).alias("ends_sha256"))

    shared = marked.where("NOT tail")
    groups = written(shared.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("member"), F.max(~F.col("last")).alias("goes_on")), "trie-groups")
    hot = hot_keys(groups, "key", "n", groups.agg(F.sum("n")).first()[0] or 0)
    rows = lookup(shared, groups, "key", [bytes(k) for k in hot], F.col("conv_id"))
    named = F.col("conv_id") == F.col("member")  # the node is credited to this conversation
    zero = F.lit(0).cast("long")
    rows = rows.select(
        "conv_id", "depth", "key", "n", "member", named.cast("long").alias("named"),
        F.when(named, (F.col("n") - 1) * F.col("chars")).otherwise(zero).alias("saving"),
        F.when(named & F.col("last") & ~F.col("goes_on"), 1).otherwise(0).cast("long").alias("leaf"))
    rows = _slices(rows, F.col("conv_id"), F.col("depth"))
    order = Window.partitionBy("conv_id", "slice").orderBy("depth")
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    summed = rows.select(
        "*", F.sum("saving").over(rest).alias("savings"), F.sum("leaf").over(rest).alias("leaves"),
        F.lead("named").over(order).alias("child"), F.lag("member").over(order).alias("parent"))
    cut = _edges_of(rows)
    if cut is None:
        plain = summed
    else:  # two rows a slice at most
        plain = summed.join(F.broadcast(cut), (F.col("conv_id") == F.col("c")) & (F.col("slice") == F.col("s")), "left").select(
            "key", "depth", "member", "n", (F.col("savings") + F.coalesce("saving_after", zero)).alias("savings"),
            (F.col("leaves") + F.coalesce("leaf_after", zero)).alias("leaves"), F.coalesce("child", "named_after").alias("child"),
            F.coalesce("parent", "member_before").alias("parent"))
    nodes = plain.groupBy("key").agg(
        F.min("member").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent_conv_id"), F.min("n").alias("n_convs"),
        F.sum(F.coalesce("child", zero)).alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("savings").alias("saved_tokens"))
    full = nodes.join(_ends(shared.where("last")), "key", "left")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256")).unionByName(tails)


def query(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS rn
  FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
           lambda a, y: list_reduce(list_concat([xor(a, y)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda b, z: xor(b >> 1, CASE WHEN b & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), size AS (
  SELECT crc.*, least(h, (SELECT count(*) FROM t WHERE t.conv_id = crc.base)) AS nh FROM crc
), turns AS (
  SELECT s.conv_id AS c, t.rn AS d, role, text FROM size s JOIN t ON t.conv_id = s.base AND t.rn <= s.h
  UNION ALL SELECT s.conv_id, s.nh + t.rn - s.h, role, text FROM size s JOIN t ON t.conv_id = s.conv_id AND t.rn > s.h
), rows_ AS MATERIALIZED (
  SELECT c, d, length(text) AS chars, string_agg(sha256(role) || sha256(text), ',') OVER (PARTITION BY c ORDER BY d) AS k,
         max(d) OVER (PARTITION BY c) AS len FROM turns
  UNION ALL SELECT conv_id, 0, 0, '', coalesce((SELECT max(d) FROM turns WHERE c = conv_id), 0) FROM size
), node AS MATERIALIZED (
  SELECT k, min(d) AS depth, min(c) AS m, count(*) AS n, min(chars) AS chars, count(*) FILTER (d < len) AS longer,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len), '')) AS ends
  FROM rows_ GROUP BY k
), up AS (
  SELECT node.k, p.m AS parent FROM node JOIN rows_ r ON r.c = node.m AND r.d = node.depth - 1 JOIN node p ON p.k = r.k
), kids AS (
  SELECT r.k, count(*) AS n_children FROM node JOIN rows_ r ON r.c = node.m AND r.d = node.depth - 1 GROUP BY r.k
), below AS (
  SELECT r.k, count(*) FILTER (node.longer = 0) AS n_leaves, sum((node.n - 1) * node.chars) AS saved
  FROM node JOIN rows_ r ON r.c = node.m AND r.d <= node.depth GROUP BY r.k
)
SELECT m AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM node LEFT JOIN up USING (k) LEFT JOIN kids USING (k) JOIN below USING (k)
"""
