"""Operator 13: cross-tokenizer alignment.

Two tokenizations of the same bytes are aligned by divide and conquer at
shared cuts: in a stretch whose two ends are shared, a common end near the
middle is located by bisecting the other side's ends, and both halves are
handled alike; a stretch without an inner cut is a leaf group.  All stretches
of a level are split together with numpy.

Neither vocabulary has a token that crosses a single space between two other
characters, so such a space is a shared cut of every text.  Texts are cut there
into units; each different unit is encoded and aligned once and kept in a
bounded cache, and what a text needs is the sum over its units.

Two passes read the texts.  The first adds up, task by task, how many links of
the corpus hold each pair of ids linked; Spark sums these counts and finds the
highest of each B id.  The second looks the counts up for each text.  The
table of pairs is broadcast if it has at most ``most_pairs`` rows (17 bytes
each); a larger one is joined to the texts' distinct pairs instead.

Defined cases: null and empty texts have no tokens, nor have texts whose joined
token bytes differ from a space and the text (for example a literal U+2581);
texts of any length are aligned whole; repeated rows count as often as they
occur; null doc_ids stay null; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import ship_package
from .common import pick, table, written

#: A character that is neither white nor invisible, whoever decides.
_SEEN = r"[^\s\u180e\u200b-\u200f\u2028-\u202f\u205f-\u2064\ufeff]"
#: Cuts a text at each single space between two such characters.
UNITS = re.compile(rf"(?<={_SEEN}) (?={_SEEN})").split
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable
    Latin-1 stands for itself, the other bytes follow from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


#: How a byte-level text falls into words (fixed value of the vocabulary).
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Spelling:
    """Both tokenizers and the bytes of their ids.

    A's file is read as ranks: its ids follow the order of its merges."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        of = byte_level()
        vocabulary = Tokenizer.from_file(a_path).get_vocab(with_added_tokens=False)
        ranks = {bytes(of[c] for c in t): i for t, i in vocabulary.items() if all(c in of for c in t)}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in ranks.items():
            self.a_bytes[i] = t
        self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = spell = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(spell.vocab_size()):
            p = spell.id_to_piece(i)
            if spell.is_byte(i):
                self.b_bytes.append(bytes([int(p[3:5], 16)]))
            else:
                self.b_bytes.append(b"" if spell.is_control(i) or spell.is_unknown(i) else p.replace("▁", " ").encode())
                if "▁" in p.lstrip("▁"):
                    raise ValueError("a piece crosses the start of a word: texts can't be cut there")

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [self.a.encode_ordinary(" " + u) for u in units], self.b.encode(units, num_threads=1)


def shared_cuts(ends_a, ends_b, first, near: int = 8):
    """Which A tokens end where a B token ends too, as a mask.

    ``ends_a`` and ``ends_b`` are rising byte offsets; ``first`` has the first
    A token of each stretch (and the number of A tokens), whose end is known to
    be shared."""
    import numpy as np

    cut = np.zeros(len(ends_a), bool)
    lo, hi = first[:-1], first[1:]
    cut[hi - 1] = True

    def common(at):  # bisect the other side
        k = np.minimum(np.searchsorted(ends_b, ends_a[at]), len(ends_b) - 1)
        return ends_b[k] == ends_a[at]

    while True:
        wide = hi - lo > 1
        lo, hi = lo[wide], hi[wide]
        if not len(lo):
            return cut
        middle = (lo + hi - 2) // 2
        found = np.full(len(lo), -1)
        todo = np.arange(len(lo))
        for k in range(near):  # ends ever farther from the middle
            for side in (k, -k) if k else (0,):
                at = middle[todo] + side
                inside = (at >= lo[todo]) & (at < hi[todo] - 1)
                hit = np.zeros(len(todo), bool)
                hit[inside] = common(at[inside])
                found[todo[hit]] = at[hit]
                todo = todo[~hit]
            todo = todo[(middle[todo] - k > lo[todo]) | (middle[todo] + k < hi[todo] - 2)]  # others are leaves
        for k in todo:  # a long stretch with no cut so near: all its inner ends at once
            inner = np.arange(lo[k], hi[k] - 1)
            inner = inner[common(inner)]
            if len(inner):
                found[k] = inner[np.argmin(np.abs(inner - middle[k]))]
        split = found >= 0
        cut[found[split]] = True
        lo, hi, found = lo[split], hi[split], found[split]
        lo, hi = np.concatenate([lo, found + 1]), np.concatenate([found + 1, hi])


def _grown(a, n: int):
    """Array ``a`` with room for ``n`` values."""
    import numpy as np

    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])


class Units:
    """Different units by number, encoded and aligned when first seen.

    Kept from task to task of a worker.  When ``most`` units (or characters of
    them) are exceeded, those seen most often stay."""

    def __init__(self, spell: Spelling, most: int = 300_000, most_chars: int = 12_000_000):
        import numpy as np

        self.spell, self.most, self.most_chars = spell, most, most_chars
        self.a_len, self.b_len = (np.array([len(x) for x in t]) for t in (spell.a_bytes, spell.b_bytes))
        size = max(len(spell.a_bytes), len(spell.b_bytes))
        self.size, self.name = size, [f"{i}{c}" for c in ",|;" for i in range(size)]
        self._reset()

    def _reset(self) -> None:
        import numpy as np

        self.number: dict[str, int] = {}
        self.bad: set[int] = set()  # units that are not spelt as they stand
        self.chars, self.groups = 0, []  # group texts
        self.counts = {c: np.zeros(1024, np.int64) for c in COUNTS[:4]}
        self.seen, self.start = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.links, self.n_links = np.zeros(8192, np.int64), 0  # link keys, unit after unit

    def full(self) -> bool:
        return len(self.number) > self.most or self.chars > self.most_chars

    def shrink(self) -> None:
        """Forget the units seen least; at most half of the room stays taken."""
        import numpy as np

        names, n = list(self.number), len(self.number)
        order = np.argsort(-self.seen[:n], kind="stable")
        size = np.cumsum([len(names[k]) for k in order.tolist()])
        fits = np.flatnonzero((size <= self.most_chars // 2) & (self.seen[order] > 1))
        old = dict(self.__dict__)
        keep = order[fits[: self.most // 2]]
        self._reset()
        for new, k in enumerate(keep.tolist()):
            self.number[names[k]] = new
            self.chars += len(names[k])
            if k in old["bad"]:
                self.bad.add(new)
        self.groups = [old["groups"][k] for k in keep.tolist()]
        for c in self.counts:
            self.counts[c] = np.append(old["counts"][c][keep], 0)
        self.seen, n_links = np.append(old["seen"][keep] // 2, 0), self.counts["n_links"][:-1]
        self.links = np.append(_gather(old["links"], old["start"][keep], n_links), 0)
        self.n_links = len(self.links) - 1
        self.start = np.append(np.cumsum(n_links) - n_links, 0)

    def _spelt(self, new: list[str]):
        """Ids of both sides and how many each unit has (none if it is not spelt
        as it stands).  A encodes all units as one text, cut where they end."""
        import numpy as np

        want = b" " + " ".join(new).encode("utf-8", "surrogatepass")
        a = np.array(self.spell.a.encode_ordinary(want.decode("utf-8", "surrogatepass")), np.int64)
        b_ids = self.spell.b.encode(new, num_threads=1)
        n_b = np.array([len(x) for x in b_ids], np.int64)
        b = np.fromiter((i for x in b_ids for i in x), np.int64, n_b.sum())
        ends = np.cumsum(np.array([len(u.encode("utf-8", "surrogatepass")) + 1 for u in new], np.int64))
        if b"".join(map(self.spell.b_bytes.__getitem__, b.tolist())) == want == b"".join(map(self.spell.a_bytes.__getitem__, a.tolist())):
            if (np.cumsum(self.b_len[b])[np.cumsum(n_b) - 1] == ends).all():
                n_a = np.diff(np.searchsorted(np.cumsum(self.a_len[a]), ends), prepend=-1)
                return a, n_a, b, n_b
        if len(new) == 1:
            return a[:0], np.zeros(1, np.int64), b[:0], np.zeros(1, np.int64)
        half = len(new) // 2
        x, y = self._spelt(new[:half]), self._spelt(new[half:])
        return tuple(np.concatenate([p, q]) for p, q in zip(x, y))

    def add(self, units) -> None:
        import numpy as np

        new = [u for u in dict.fromkeys(units) if u not in self.number]
        if not new:
            return
        a, n_a, b, n_b = self._spelt(new)
        first_number, total = len(self.number), len(self.number) + len(new)
        self.number.update(zip(new, range(first_number, total)))
        self.chars += sum(map(len, new))
        at = np.flatnonzero(n_a)
        self.bad.update((first_number + np.flatnonzero(n_a == 0)).tolist())
        groups = [""] * len(new)
        got = {c: np.zeros(len(new), np.int64) for c in self.counts} | {"n_a": n_a, "n_b": n_b}
        keys = np.zeros(0, np.int64)
        if len(at):
            ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
            first = np.concatenate([[0], np.cumsum(n_a[at])])
            cut = shared_cuts(ends_a, ends_b, first)
            got["n_groups"][at] = np.add.reduceat(cut.astype(np.int64), first[:-1])
            # links: each stretch between neighbouring ends lies in one token of either side
            ends = np.union1d(ends_a, ends_b)
            keys = (a[np.searchsorted(ends_a, ends)] << 32) | b[np.searchsorted(ends_b, ends)]
            stop = np.searchsorted(ends, ends_a[first[1:] - 1]) + 1
            got["n_links"][at] = np.diff(stop, prepend=0)
            # group texts: A ids, B ids of group after group
            cuts = ends_a[cut]
            where = np.concatenate([2 * np.searchsorted(cuts, ends_a), 2 * np.searchsorted(cuts, ends_b) + 1])
            order = np.argsort(where, kind="stable")
            side = where[order]
            last = np.append(side[1:] != side[:-1], True)
            names = np.concatenate([a, b])[order] + np.where(last, 1 + (side & 1), 0) * self.size
            names = list(map(self.name.__getitem__, names.tolist()))
            stops = np.cumsum(n_a[at] + n_b[at]).tolist()
            for k, x, y in zip(at.tolist(), [0, *stops], stops):
                groups[k] = "".join(names[x:y])
        self.groups += groups
        for c in self.counts:
            self.counts[c] = _grown(self.counts[c], total)
            self.counts[c][first_number:total] = got[c]
        self.seen, self.start = _grown(self.seen, total), _grown(self.start, total)
        self.start[first_number:total] = self.n_links + np.cumsum(got["n_links"]) - got["n_links"]
        self.links = _grown(self.links, self.n_links + len(keys))
        self.links[self.n_links : self.n_links + len(keys)] = keys
        self.n_links += len(keys)

    def of(self, texts: list[str | None]) -> Iterator[tuple]:
        """Slice after slice of the texts: the numbers of their units, end to end,
        and how many each text has (none: a text without tokens).  Units are
        forgotten only between slices."""
        import numpy as np

        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and chars < 1_000_000:
                chars += len(texts[stop] or "")
                stop += 1
            parts = [units_of(t) if t else [] for t in texts[at:stop]]
            self.add(u for p in parts for u in p)
            size = np.array([len(p) for p in parts], np.int64)
            numbers = np.fromiter((self.number[u] for p in parts for u in p), np.int64, size.sum())
            if self.bad and not self.bad.isdisjoint(numbers.tolist()):
                out = np.split(numbers, np.cumsum(size)[:-1])
                for k, ids in enumerate(out):
                    if not self.bad.isdisjoint(ids.tolist()):  # decided on the text as a whole
                        self.add([texts[at + k]])
                        whole = self.number[texts[at + k]]
                        out[k] = np.array([] if whole in self.bad else [whole], np.int64)
                numbers, size = np.concatenate(out), np.array([len(x) for x in out], np.int64)
            np.add.at(self.seen, numbers, 1)
            yield numbers, size
            if self.full():
                self.shrink()
            at = stop


def _gather(values, start, n):
    """Stretches of ``values``, end to end."""
    import numpy as np

    shift = start - (np.cumsum(n) - n)
    return values[np.arange(int(n.sum())) + np.repeat(shift, n)]


_ODD = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")


def units_of(text: str) -> list[str]:
    """The units of a text; quick where its only white space is plain."""
    if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or _ODD.search(text):
        return UNITS(text)
    return text.split(" ")


_UNITS: dict[tuple, Units] = {}  # of this Python worker


def units(paths: tuple[str, str]) -> Units:
    if paths not in _UNITS:
        _UNITS[paths] = Units(Spelling(*paths))
    return _UNITS[paths]


def pair_counts(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """key (A id << 32 | B id), n (links of the corpus), best (no pair of its B
    id has more)."""
    ship_package(docs.sparkSession)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, keys, times = 0, [], []

        def flush():
            k, which = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(which, weights=np.concatenate(times), minlength=len(k)).astype(np.int64)
            return k, total

        known = units(paths)
        for b in batches:
            for numbers, _ in known.of(b.column(0).to_pylist()):
                used, n = np.unique(numbers, return_counts=True)
                links = known.counts["n_links"][used]
                keys.append(_gather(known.links, known.start[used], links))
                times.append(np.repeat(n, links))
                held += len(keys[-1])
                if held > 2_000_000:  # one row a pair, so far
                    k, total = flush()
                    keys, times, held = [k], [total], 0
                    if len(k) > 1_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total)], ["key", "n"])
                        keys, times = [], []
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in flush()], ["key", "n"])

    counted = pick(docs, "text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # at most one row for each A id in a window
    highest = F.max("n").over(Window.partitionBy(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))))
    return written(counted.select("key", "n", (F.col("n") == highest).alias("best")), "pair-counts")


def align(docs: DataFrame, a_path: str, b_path: str, most_pairs: int = 2_000_000) -> DataFrame:
    """doc_id, the group text (`a1,a2|b1;a3|b2,b3`, empty without tokens), n_a,
    n_b, n_groups, n_links, n_best and count_sum, one row per input row."""
    import numpy as np

    spark, paths = docs.sparkSession, (a_path, b_path)
    pairs = pair_counts(docs, paths)
    known = pairs.count() <= most_pairs
    shared = None
    if known:
        got = pairs.orderBy("key").toPandas()
        shared = spark.sparkContext.broadcast(
            (got["key"].to_numpy(np.int64), got["n"].to_numpy(np.int64), got["best"].to_numpy(bool)))
    d = pick(docs, "doc_id", "text")
    columns = ["doc_id", "groups", *COUNTS]

    def run(batches) -> Iterator:
        import pyarrow as pa

        cache = units(paths)
        for b in batches:
            at, ids = 0, b.column(0)
            for numbers, size in cache.of(b.column(1).to_pylist()):
                start = np.cumsum(size) - size
                total = lambda v: np.add.reduceat(np.append(v, 0), start) * (size > 0)  # noqa: E731, B023
                sums = {c: total(v[numbers]) for c, v in cache.counts.items()}
                used, which = np.unique(numbers, return_inverse=True)
                n = cache.counts["n_links"][used]
                keys = _gather(cache.links, cache.start[used], n)
                found = dict.fromkeys(("n_best", "count_sum"), np.zeros(len(size), np.int64))
                if known and len(used):
                    pair, count, best = shared.value
                    k = np.searchsorted(pair, keys)
                    by_unit = np.cumsum(n) - n
                    found = {"n_best": total(np.add.reduceat(best[k].astype(np.int64), by_unit)[which]),
                             "count_sum": total(np.add.reduceat(count[k], by_unit)[which])}
                texts = list(map(cache.groups.__getitem__, numbers.tolist()))
                texts = ["".join(texts[x : x + n])[:-1] for x, n in zip(start.tolist(), size.tolist())]
                out = [ids.slice(at, len(size)), pa.array(texts, pa.string()), *[pa.array((sums | found)[c]) for c in COUNTS]]
                names = columns
                if not known:
                    each = [np.unique(_gather(cache.links, cache.start[x], cache.counts["n_links"][x]), return_counts=True)
                            for x in np.split(numbers, start[1:])]
                    out += [pa.array([list(v[j]) for v in each], pa.list_(pa.int64())) for j in (0, 1)]
                    names = [*columns, "keys", "times"]
                yield pa.RecordBatch.from_arrays(out, names)
                at += len(size)

    schema = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, groups string" + "".join(f", {c} long" for c in COUNTS)
    if known:
        return d.mapInArrow(run, schema)
    rows = d.mapInArrow(run, schema + ", keys array<long>, times array<long>")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "aligned-rows")
    one = rows.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("row", "x.keys", "x.times")
    # a frequent pair stands in many texts: its counts are repeated over salts
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = F.col("n") * 256 >= F.lit(max(256, rows.agg(F.sum("n_links")).first()[0] or 0))
    dealt = pairs.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(-1)))))
    hot_keys = [r[0] for r in pairs.where(hot).select("key").collect()]  # 256 at most
    salt = F.when(F.col("keys").isin(hot_keys), F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")).otherwise(-1) if hot_keys else F.lit(-1)
    found = one.withColumn("salt", salt).join(dealt.withColumnRenamed("key", "keys"), ["keys", "salt"])
    sums = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("nb"),
                                    F.sum(F.col("times") * F.col("n")).alias("cs"))
    out = rows.drop("n_best", "count_sum", "keys", "times").join(sums, "row", "left")
    return out.select("doc_id", "groups", "n_a", "n_b", "n_groups", "n_links",
                      F.coalesce("nb", F.lit(0)).alias("n_best"), F.coalesce("cs", F.lit(0)).alias("count_sum"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    out = align(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups"), 256))
    return out.select("doc_id", *COUNTS, digest.alias("groups_sha256"))
