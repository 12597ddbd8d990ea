"""Operator 7: n-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct word shingles (64-bit hashes).  Equal
sets are one *class*; only classes are joined, so copies cost nothing.

Candidates: in one global order of shingles (those frequent in a sample last)
two sets of the wanted similarity must share ``k`` shingles (4 or a twentieth, or
all that a small set needs) within their first ``n - ceil(t n) + k``.  Every text
is shingled once, and this prefix crosses one exchange.  Classes that share such
a shingle form a group; a class that shares fewer than ``k`` in all links to
nothing and leaves.  Chains of groups (cut where sizes jump too far) are
*neighbourhoods*: no link leaves one.

Count vectors: shingles are hashed into coordinates; a class is the point of
its counts.  The sum of coordinate minima of two points bounds their overlap
from above, and so does the sum of minima of a point and the upper corner of a
box of points.

The join is two rounds of jobs.  First the points of a neighbourhood go to one
task (cut into blocks, and block against block, if there are many), are
bulk-loaded into R-trees and joined, box against box and then point against
point; only a spanning forest of the pairs that pass the bound leaves the task.
Its components are small, and almost all of their classes are near copies.
Then the full sets of such a component go to one task in the same way, where the
R-tree join is run again and every pair that passes and is not connected yet is
verified at once; again only a spanning forest, now of links, leaves the task.
So no exchange carries pairs.  A neighbourhood of more than ``wide`` blocks is
split by shingle instead: each group of it is a job of its own.

Defined cases: null or empty text has an empty set, links to nothing and is
its own component; null doc_ids belong to components but never name one unless
no member has an id; repeated rows are copies; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import boxed, discard, hot_keys, lookup, pick, table, unboxed, written
from .graph import components

WIDTH, NEED = 5, 80  # words in a shingle; per cent of the union that must be shared
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_WORDS: dict[bytes, bytes] = {}  # word hashes of this Python worker


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, width: int = WIDTH):
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return np.zeros(0, dtype=np.int64)
    found = list(map(_WORDS.get, words))
    if None in found:
        if len(_WORDS) > 500_000:
            _WORDS.clear()
        for w, f in zip(words, found):
            if f is None:
                _WORDS[w] = xxhash.xxh64_digest(w)
        found = [f or xxhash.xxh64_digest(w) for w, f in zip(words, found)]
    h = np.frombuffer(b"".join(found), dtype=np.uint64)
    n = min(width, len(h))
    odd = [((_ODD[k % 5] * (2 * (k // 5) + 1)) & (2**64 - 1)) | 1 for k in range(n)]
    total = np.full(len(h) - n + 1, _ODD[0] * (n + 1) & (2**64 - 1), dtype=np.uint64)
    for k in range(n):  # words are hashed already: odd multiples of them are enough, mixed once
        total += h[k : len(h) - n + 1 + k] * np.uint64(odd[k])
    return np.unique(_mix(total)).view(np.int64)


def shared_least(n: int, need: int = NEED) -> int:
    """How many shingles of its prefix a set of ``n`` shares with any set it
    links to: 4 or a twentieth, or all that a small set needs."""
    return min(max(4, n // 20), -(-need * n // 100))


def prefix_length(n: int, need: int = NEED) -> int:
    """If ``o`` shingles are common, the first ``n - o + k`` hold ``k`` of them."""
    return n - -(-need * n // 100) + shared_least(n, need)


def dims(n: int) -> int:
    """Coordinates of a set of ``n``: a power of two with 4 to 8 shingles each."""
    return 1 << max(4, (max(1, n) // 4).bit_length() - 1)


def vector(s):
    """Counts of shingles by coordinate.  Halving the number of coordinates
    adds up neighbours, so sets of different sizes stay comparable."""
    import numpy as np

    d = dims(len(s))
    return np.bincount((_mix(s.view(np.uint64)) >> np.uint64(64 - d.bit_length() + 1)).astype(np.int64), minlength=d).astype(np.uint16)


def fold(v, d: int):
    """Vectors (rows) with ``d`` coordinates."""
    return v if v.shape[-1] == d else v.reshape(*v.shape[:-1], d, -1).sum(-1)


class RTree:
    """Points in boxes of ``fan``, boxes in boxes, bulk-loaded in order of size
    and then of the heaviest coordinates; each box has its upper corner, size
    range and component (or -1 for several)."""

    def __init__(self, points, sizes, comps, fan: int = 16):
        import numpy as np

        self.order = np.lexsort((points.argmax(1), comps, sizes))
        lo = hi = sizes[self.order]
        corner, comp = points[self.order].astype(np.int32), comps[self.order]
        self.fan, self.levels = fan, [(corner, lo, hi, comp)]
        while len(corner) > fan:
            at = np.arange(0, len(corner), fan)
            same = np.minimum.reduceat(comp, at) == np.maximum.reduceat(comp, at)
            corner, lo, hi = np.maximum.reduceat(corner, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            comp = np.where(same, comp[at], -1)
            self.levels.append((corner, lo, hi, comp))

    def join(self, other: "RTree", need: int = NEED, chunk: int = 4096) -> Iterator:
        """Index pairs (into the two point lists) that the bounds let pass."""
        import numpy as np

        top = max(len(self.levels), len(other.levels)) - 1
        level = lambda t, k: min(k, len(t.levels) - 1)
        a0, b0 = len(self.levels[level(self, top)][1]), len(other.levels[level(other, top)][1])
        start = np.indices((a0, b0)).reshape(2, -1).T
        stack = [(top, start)]
        while stack:
            k, pairs = stack.pop()
            if len(pairs) > chunk:
                stack.append((k, pairs[chunk:]))
                pairs = pairs[:chunk]
            ka, kb = level(self, k), level(other, k)
            if self is other:
                pairs = pairs[pairs[:, 0] <= pairs[:, 1]]
                if k == 0:
                    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
            (ca, la, ha, pa), (cb, lb, hb, pb) = self.levels[ka], other.levels[kb]
            i, j = pairs[:, 0], pairs[:, 1]
            ok = (100 * ha[i] >= need * lb[j]) & (100 * hb[j] >= need * la[i]) & ((pa[i] != pb[j]) | (pa[i] < 0))
            i, j = i[ok], j[ok]
            d = max(1, (1 << 22) // ca.shape[1])
            over = np.concatenate([np.minimum(ca[i[x : x + d]], cb[j[x : x + d]]).sum(1) for x in range(0, len(i), d)]) if len(i) else i
            # overlap o of sizes a and b: 100 o >= need (a + b - o); no box has less than its least size
            ok = (100 + need) * over >= need * (la[i] + lb[j])
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            if k == 0:
                yield self.order[i], other.order[j]
                continue
            na, nb = level(self, k - 1), level(other, k - 1)
            kids = []
            for x, n, before, t in ((i, na, ka, self), (j, nb, kb, other)):
                if n == before:
                    kids.append((x[:, None], np.ones((len(x), 1), bool)))
                else:
                    c = x[:, None] * t.fan + np.arange(t.fan)
                    kids.append((c, c < len(t.levels[n][1])))
            (ia, oka), (jb, okb) = kids
            grid = np.stack(np.broadcast_arrays(ia[:, :, None], jb[:, None, :]), -1)[oka[:, :, None] & okb[:, None, :]]
            stack.append((k - 1, grid))


def _docs(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").withColumn("mix", F.xxhash64("text"))


def _class(s) -> int:
    """64-bit name of a shingle set; with the set's size it identifies a class."""
    import xxhash

    return xxhash.xxh64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63)


def sets_of(docs: DataFrame, order: dict | None = None, most: int = 1 << 19) -> DataFrame:
    """doc_id, mix (hash of the text), n, c (class; null for an empty set) and,
    once for each class of a task (else null), prefix (the first shingles in the
    global order) and v (the count vector)."""
    import numpy as np

    order = order or {}
    frequent_ = np.array(sorted(order), dtype=np.int64)
    counts = np.array([order[x] for x in sorted(order)], dtype=np.int64)

    def run(batches) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        for b in batches:
            if len(seen) > most:
                seen.clear()
            size, name, prefix, points = [], [], [], []
            for t in b.column(1):
                s = shingles(t.as_py())
                n, c, first, point = len(s), None, None, None
                if n and (c := _class(s)) not in seen:
                    seen.add(c)
                    point = vector(s).tobytes()
                    if len(frequent_):
                        k = np.minimum(np.searchsorted(frequent_, s), len(frequent_) - 1)
                        s = s[np.lexsort((s, np.where(frequent_[k] == s, counts[k], 0)))]
                    first = s[: prefix_length(n)]
                size.append(n)
                name.append(c)
                prefix.append(first)
                points.append(point)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(size, pa.int64()), pa.array(name, pa.int64()),
                                              pa.array(prefix, pa.list_(pa.int64())), pa.array(points, pa.binary())],
                                             ["doc_id", "mix", "n", "c", "prefix", "v"])

    d = _docs(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, mix long, n long, c long, prefix array<long>, v binary")


def frequent(docs: DataFrame, rows: int, sample_rows: int = 20_000, least: int = 3, most: int = 200_000) -> dict:
    """Shingles found in ``least`` or more texts of a sample, with their counts.

    They only set the global order (any order is right); ``sample_rows`` and
    ``most`` bound the sample and the list."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            got = [shingles(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*got, np.zeros(0, np.int64)]))], ["s"])

    share = min(1.0, sample_rows / max(1, rows))
    counted = pick(docs, "text").sample(False, share, 11).mapInArrow(run, "s long").groupBy("s").count()
    found = counted.where(F.col("count") >= least).orderBy(F.desc("count"), "s").limit(most).collect()
    return {r[0]: r[1] for r in found}


def groups_of(sets: DataFrame, order: dict, rows: int) -> DataFrame:
    """(token, salt, c, n, before, n_before) of classes that share a prefix
    shingle with enough others; ``before`` is the next smaller class of the
    group.  Tokens that the sample shows in more than 1/256 of the texts are
    salted by class."""
    spark = sets.sparkSession
    hot = [k for k, v in order.items() if v * 256 >= min(rows, 20_000)]
    is_hot = F.col("token").isin(hot) if hot else F.lit(False)
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tokens = sets.where("prefix IS NOT NULL").select(F.explode("prefix").alias("token"), "c", F.col("n").cast("int").alias("n"))
    dealt = tokens.withColumn("salt", F.when(is_hot, F.pmod("c", F.lit(salts))).otherwise(-1).cast("int"))
    kind = "token long, salt int, c long, n int, before long, n_before int"

    def grouped(d: DataFrame, name: str) -> DataFrame:
        placed = d.select("token", "c", "n", "salt").repartition(F.col("token"), F.col("salt"))
        return written(placed.sortWithinPartitions("token", "salt", "n", "c").mapInArrow(_shared, kind), name)

    first = grouped(dealt, "jaccard-shared")
    # shared_least of the smallest set that a class can link to
    least = F.expr(f"least(greatest(4, (({NEED} * n + 99) div 100) div 20), ({NEED} * (({NEED} * n + 99) div 100) + 99) div 100)")
    enough = first.groupBy("c").agg(F.count("*").alias("k"), F.first("n").alias("n")).where(F.col("k") >= least).select("c")
    out = grouped(first.join(enough, "c", "left_semi"), "jaccard-groups")
    discard(first)
    return out


def _shared(batches) -> Iterator:
    """Of rows sorted by token, salt, n, c: the distinct ones whose group has
    more than one class (salted groups whole), each with its predecessor."""
    import numpy as np
    import pyarrow as pa

    held = None  # rows of the last group so far, which may go on: at most its last row is needed
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in range(4)]  # token, c, n, salt
        token, c, n, salt = cols
        if held is not None:
            token, c, n, salt = (np.concatenate([[x], y]) for x, y in zip(held[:4], (token, c, n, salt)))
        same = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        new = np.append(True, ~(same & (c[1:] == c[:-1])))
        out_first = held is not None and held[4]  # the held row is out already
        token, c, n, salt = token[new], c[new], n[new], salt[new]
        same = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        after, before = np.append(same, False), np.append(False, same)
        keep = after | before | (salt >= 0)
        last_out = bool(keep[-1]) if len(keep) > 1 or not out_first else True
        prev, n_prev = np.append(0, c[:-1]), np.append(0, n[:-1])
        emit = keep.copy()
        if out_first:
            emit[0] = False
        held = (token[-1], c[-1], n[-1], salt[-1], last_out)
        yield pa.RecordBatch.from_arrays([
            pa.array(token[emit]), pa.array(salt[emit].astype(np.int32)), pa.array(c[emit]), pa.array(n[emit].astype(np.int32)),
            pa.array(prev[emit], mask=~before[emit]), pa.array(n_prev[emit].astype(np.int32), mask=~before[emit]),
        ], ["token", "salt", "c", "n", "before", "n_before"])


def _once(batches, most: int = 1 << 19) -> Iterator:
    """Rows (mix, text) without those whose mix came before in the task: copies
    of a text leave a task once (or once every ``most`` distinct texts)."""
    import numpy as np
    import pyarrow as pa

    seen: set[int] = set()
    for b in batches:
        if len(seen) > most:
            seen.clear()
        values, at = np.unique(b.column(0).to_numpy(), return_index=True)
        at = sorted(k for v, k in zip(values.tolist(), at.tolist()) if v not in seen)
        seen.update(values.tolist())
        if at:
            yield b.take(pa.array(at, pa.int64()))


def _bits(values: DataFrame, column: str, most: int = 1 << 28):
    """A bitmap that has every value's bit (16 bits a value, 32 MB at most), to
    be broadcast: rows without their bit need not be moved."""
    import numpy as np

    size = min(most, max(1 << 16, 1 << (16 * max(1, values.count()) - 1).bit_length()))
    at = F.pmod(F.col(column), F.lit(size))
    words = values.select(F.floor(at / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("b"))
    got = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(size // 64, np.int64)
    out[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64)
    return values.sparkSession.sparkContext.broadcast(out)


def contents(docs: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Shingle sets of the given classes: c, n, s and further columns of
    ``classes`` (one row a class).  One text of each class is found again by its
    hash and shingled again; other texts don't leave their task."""
    extra = [c for c in classes.columns if c != "c"]
    named = sets.where("c IS NOT NULL").groupBy("c").agg(F.min("mix").alias("mix"))
    one = written(named.join(classes, "c"), "jaccard-texts")
    bits = _bits(one, "mix")

    def wanted(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        have = bits.value

        def some():
            for b in batches:
                at = np.mod(b.column(0).to_numpy(), len(have) * 64)
                yield b.filter(pa.array(have[at >> 6] >> (at & 63) & 1 == 1))

        yield from _once(some())

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            got = [shingles(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([len(s) for s in got], pa.int32()), pa.array(got, pa.list_(pa.int64())),
                 *[b.column(2 + k) for k in range(len(extra))]], ["c", "n", "s", *extra])

    texts = _docs(docs).select("mix", "text").mapInArrow(wanted, "mix long, text string").dropDuplicates(["mix"])
    found = texts.join(one, "mix").select("text", "c", *extra)
    schema = "c long, n int, s array<long>" + "".join(f", {c} {classes.schema[c].dataType.simpleString()}" for c in extra)
    return found.mapInArrow(run, schema)


class Points:
    """The classes of one job, connected as far as is known, and the R-tree join
    of their count vectors."""

    def __init__(self, names, sizes, vectors, side, cross: bool):
        import numpy as np

        self.names, self.size, self.vectors, self.side, self.cross = names, np.array(sizes, np.int64), vectors, side, cross
        self.label = np.arange(len(names))  # component of each class

    def candidates(self) -> Iterator:
        """Pairs of index arrays that the count vectors allow."""
        import numpy as np

        by: dict[int, list[int]] = {}
        for k, v in enumerate(self.vectors):
            by.setdefault(len(v), []).append(k)

        def tree(rows, d):
            rows = np.array(rows)
            return rows, RTree(np.stack([fold(self.vectors[k].astype(np.int32), d) for k in rows]), self.size[rows], rows)

        for d, rows in by.items():
            split = lambda r: [[k for k in r if self.side[k] == x] for x in (0, 1)] if self.cross else [r, r]
            (a, b), (near_a, near_b) = split(rows), split(by.get(2 * d, []))
            for x, y in [(a, b), (a, near_b), (b, near_a)] if self.cross else [(rows, rows), (rows, near_a)]:
                if len(x) and len(y):
                    rx, tx = tree(x, d)
                    ry, ty = (rx, tx) if x is y else tree(y, d)
                    for p, q in tx.join(ty):
                        yield rx[p], ry[q]

    def connect(self, i: int, j: int) -> tuple[int, int]:
        self.label[self.label == self.label[j]] = self.label[i]
        return int(self.names[i]), int(self.names[j])

    def links(self) -> Iterator[tuple[int, int]]:
        """A spanning forest of the pairs that the bound lets pass."""
        for p, q in self.candidates():
            while len(p):
                open_ = self.label[p] != self.label[q]
                p, q = p[open_], q[open_]
                if len(p):
                    yield self.connect(int(p[0]), int(q[0]))


class Linker(Points):
    """Points with their full sets: pairs that pass are verified."""

    def __init__(self, names, sets, side, cross: bool):
        import numpy as np

        super().__init__(names, [len(x) for x in sets], [vector(x) for x in sets], side, cross)
        self.stop = np.cumsum(self.size)
        _, self.flat = np.unique(np.concatenate(sets), return_inverse=True)  # shingles by rank
        self.mark = np.zeros(int(self.flat.max()) + 1 if len(self.flat) else 1, np.int32)

    def of(self, k: int):
        return self.flat[self.stop[k] - self.size[k] : self.stop[k]]

    def links(self) -> Iterator[tuple[int, int]]:
        """A spanning forest of the links: at most one a class less one."""
        import numpy as np

        for p, q in self.candidates():
            order = np.argsort(p, kind="stable")
            p, q = p[order], q[order]
            for i, js in zip(p[np.flatnonzero(np.diff(p, prepend=-1))].tolist(), np.split(q, np.flatnonzero(np.diff(p)) + 1)):
                js = js[self.label[js] != self.label[i]]
                if not len(js):
                    continue
                self.mark[self.of(i)] = 1
                n = self.size[js]
                start = np.cumsum(n) - n
                at = np.arange(n.sum()) + np.repeat(self.stop[js] - n - start, n)
                both = np.add.reduceat(self.mark[self.flat[at]], start)
                self.mark[self.of(i)] = 0
                for j in js[(100 + NEED) * both >= NEED * (self.size[i] + n)].tolist():
                    if self.label[i] != self.label[j]:
                        yield self.connect(i, j)


def _forests(batches) -> Iterator:
    """Rows (kind, job, i, j, side, c, n, and s, the set, or v, the vector)
    sorted by the first four: a spanning forest of each job's links, or of the
    pairs that may be.  One job is in memory at a time."""
    import numpy as np
    import pyarrow as pa

    key, rows = None, {}
    out: list[tuple] = []

    def close():
        if len(rows) > 1:
            names, (side, size, what) = list(rows), zip(*rows.values())
            cross = key[2] != key[3]
            job = Linker(names, what, side, cross) if sets else Points(names, size, [np.frombuffer(x, np.uint16) for x in what], side, cross)
            out.extend(job.links())
        rows.clear()

    def ready():
        got = pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["u", "v"])
        out.clear()
        return got

    sets = False
    for b in batches:
        sets = b.schema.names[7] == "s"
        keys = list(zip(*(b.column(k).to_pylist() for k in range(4))))
        if sets:
            flat, ends = b.column(7).values.to_numpy(), b.column(7).offsets.to_numpy()
            what = [flat[x:y] for x, y in zip(ends, ends[1:])]
        else:
            what = b.column(7).to_pylist()
        for now, side, c, n, x in zip(keys, *(b.column(k).to_pylist() for k in (4, 5, 6)), what):
            if now != key:
                close()
                key = now
            rows[c] = (side, n, x.copy() if sets else x)
        if len(out) > 20_000:
            yield ready()
    close()
    if out:
        yield ready()


def neighbourhoods(groups: DataFrame, per_task: int = 1 << 18) -> DataFrame:
    """(c, n, home): classes that may link to others and the neighbourhood they
    lie in.  A salted group is connected whole, since its sizes are spread over
    its salts."""
    chain = groups.where(F.col("before").isNotNull() & ((F.col("salt") >= 0) | (100 * F.col("n_before") >= NEED * F.col("n"))))
    firsts = groups.where("salt >= 0").groupBy("token", "salt").agg(F.min("c").alias("first"))
    hub = firsts.groupBy("token").agg(F.min("first").alias("hub"))
    spokes = firsts.join(hub, "token").select(F.col("first").alias("u"), F.col("hub").alias("v"))
    edges = chain.select(F.col("c").alias("u"), F.col("before").alias("v")).unionByName(spokes)
    return _homes(groups.groupBy("c").agg(F.first("n").alias("n")), edges.where("u <> v").distinct(), per_task)


def _homes(sizes: DataFrame, edges: DataFrame, per_task: int) -> DataFrame:
    """(c, n, home) of the classes that ``edges`` connect."""
    homes = components(edges, per_task).withColumnRenamed("node", "c").withColumnRenamed("component", "home")
    return written(sizes.select("c", "n").join(homes, "c"), "jaccard-homes")


def jobs_of(groups: DataFrame, members: DataFrame, block: int = 256, block_shingles: int = 1 << 20, spread: int = 16,
            wide: int = 64) -> DataFrame:
    """(c, jobs): where each class's set goes, as (kind, job, i, j, side).

    A job has at most two blocks.  A block has ``block`` classes, or a
    ``spread``-th of its neighbourhood if that is more, but no more than about
    ``block_shingles`` shingles (or one set)."""

    def blocks_of(rows: DataFrame, key: str) -> DataFrame:
        sums = rows.groupBy(key).agg(F.count("*").alias("m"), F.sum("n").alias("total"))
        return sums.where("m > 1").select(key, "m", F.greatest(
            F.least(F.lit(spread), F.ceil(F.col("m") / block)), F.ceil(F.col("total") / block_shingles)).cast("int").alias("blocks"))

    def placed(rows: DataFrame, key: str, sums: DataFrame, kind: int) -> DataFrame:
        hot = hot_keys(sums, key, "m", max(1, sums.agg(F.sum("m")).first()[0] or 0))
        dealt = lookup(rows, sums.select(key, "blocks"), key, hot, F.col("c")).where("blocks IS NOT NULL")
        dealt = dealt.withColumn("at", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return dealt.select("c", F.struct(
            F.lit(kind).alias("kind"), F.col(key).alias("job"), F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
            F.when(F.col("at") <= F.col("other"), 0).otherwise(1).alias("side")).alias("x"))

    sums = written(blocks_of(members, "home"), "jaccard-sizes")
    out = placed(members, "home", sums.where(F.col("blocks") <= wide), 0)
    giant = sums.where(F.col("blocks") > wide)
    if giant.limit(1).count():
        inside = members.join(giant.select("home"), "home", "left_semi").select("c")
        rows = groups.select("token", "c", "n").distinct().join(inside, "c", "left_semi")
        out = out.unionByName(placed(rows, "token", written(blocks_of(rows, "token"), "jaccard-sizes"), 1))
    return out.groupBy("c").agg(F.collect_list("x").alias("jobs"))


def links(docs: DataFrame, block: int = 256, per_task: int = 1 << 18, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """(sets, components): the set table of all rows (doc_id, n, c) and the
    component of every class that is linked to another."""
    ship_package(docs.sparkSession)
    rows = docs.count()
    order = frequent(docs, rows)
    sets = written(sets_of(docs, order), "jaccard-rows")
    groups = groups_of(sets, order, rows)
    members = neighbourhoods(groups, per_task)

    def forest(rows: DataFrame, what: str) -> DataFrame:
        """Rows (c, n, jobs, and the column ``what``) to a forest of their jobs."""
        dealt = rows.select("c", "n", what, F.explode("jobs").alias("x")).select("x.kind", "x.job", "x.i", "x.j", "x.side", "c", "n", what)
        placed = dealt.repartition("kind", "job", "i", "j").sortWithinPartitions("kind", "job", "i", "j")
        return written(placed.mapInArrow(_forests, "u long, v long"), "jaccard-forest")

    points = sets.where("v IS NOT NULL").select("c", F.col("n").cast("int").alias("n"), "v")
    near = forest(points.join(jobs_of(groups, members, block, **sizes), "c"), "v")
    close = _homes(members, near, per_task)
    linked = forest(contents(docs, sets, jobs_of(groups, close, block, **sizes)), "s")
    discard(groups, members, near, close)
    return sets, components(linked, per_task)


def join(docs: DataFrame, block: int = 256, per_task: int = 1 << 18, **sizes: int) -> DataFrame:
    """doc_id, n_shingles, component_id; one row per input row."""
    sets, linked = links(docs, block, per_task, **sizes)
    named = sets.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("least"), F.count("*").alias("k"))
    named = written(named.join(linked.withColumnRenamed("node", "c"), "c", "left")
                    .withColumn("component", F.coalesce("component", "c")), "jaccard-classes")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    n = named.count()
    hot = hot_keys(named.groupBy("component").agg(F.count("*").alias("n")), "component", "n", n) if n else []
    of_class = lookup(named, ids, "component", hot, F.col("c")).select("c", "component_id")
    hot = hot_keys(named, "c", "k", sets.count())
    out = lookup(sets, of_class, "c", hot, F.struct("doc_id", "mix"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def filter_docs(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row whose doc_id
    names it, and every row with an empty set."""
    marks = join(docs).where("n_shingles = 0 OR doc_id <=> component_id").select(F.col("doc_id").alias("_id")).distinct()
    rows = boxed(docs, "doc_id").join(written(marks, "jaccard-kept"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return unboxed(rows, docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), pos AS (
  SELECT r, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) >= 5
), win AS (
  SELECT r, lead(x, 4) OVER o AS last,
         concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS g
  FROM pos WINDOW o AS (PARTITION BY r ORDER BY i)
), sh AS MATERIALIZED (
  SELECT DISTINCT r, g FROM win WHERE last IS NOT NULL
  UNION ALL SELECT r, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4
), n AS MATERIALIZED (
  SELECT r, count(*) AS n FROM sh GROUP BY r
), e AS MATERIALIZED (
  SELECT a.r AS u, b.r AS v FROM sh a JOIN sh b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r
  HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE r = a.r) + (SELECT n FROM n WHERE r = b.r) - count(*))
), reach AS (
  SELECT r AS u, r AS v FROM n UNION SELECT reach.u, e.v FROM reach JOIN e ON reach.v = e.u
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least_id, doc_id) AS component_id
FROM w LEFT JOIN n USING (r)
LEFT JOIN (SELECT reach.u AS r, min(w.doc_id) AS least_id FROM reach JOIN w ON w.r = reach.v GROUP BY reach.u) USING (r)
"""
