"""Operator 5: sum-of-squares online packing.

Each task reads its documents as a stream, tokenises them and places them at
once, with no shuffle.  Whole windows of a long document are cut off first;
its remainder goes, by the sum-of-squares rule, into the open window whose
fill level minimises the sum over levels of (number of open windows at that
level) squared, or into a new window.  The counts live in one array indexed
by level.  At the end of a task (or when ``max_open`` windows are open, to
bound memory) the open windows are poured together, cutting pieces, so that
at most one window a task is padded.

Tokens equal ``tokenizers`` on the whole text with add_special_tokens=False:
the vocabulary drops white space between words, so a text is cut at ASCII
blanks and each different word is encoded once and kept in a bounded cache.
A document is its ids and then id 1.

Defined cases: a null or empty text is the one id 1; texts of any length are
cut into as many windows as needed; repeated rows are separate documents; null
doc_ids stay null; an empty table gives an empty result; extra columns are
ignored.  Which window a piece lands in depends on how the input is split into
tasks; the guarantees do not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from ..session import ship_package
from .common import pick, table

WINDOW = 2048
END = b"\x01\x00\x00\x00"  # id 1, the end of a document
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordCache:
    """Little-endian uint32 ids of words, as bytes; two generations of at most
    ``size`` words each, so that frequent words stay."""

    def __init__(self, path: str, size: int = 600_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer, self.size = Tokenizer.from_file(path), size
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _encode(self, words: list[str], together: int = 500) -> None:
        """Words of letters only are one pre-token each, so many can be encoded
        in one call and told apart by the word-end mark; others go alone."""
        import numpy as np

        letters = [w for w in words if w.isalpha()]
        alone = [w for w in words if not w.isalpha()]
        groups = [letters[k : k + together] for k in range(0, len(letters), together)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) != len(group):  # a letter that lower-cases to more than letters
                alone += group
                continue
            data = ids.tobytes()
            self.new.update(zip(group, map(lambda a, b: data[a:b], [0, *ends], ends)))
        for w, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.new[w] = np.asarray(e.ids, dtype="<u4").tobytes()

    def _add(self, missing: set[str]) -> None:
        if len(self.new) > self.size:
            self.old, self.new = self.new, {"": b""}
        new, old = self.new, self.old
        made: dict[str, tuple[str, str]] = {}  # word -> the simpler word and mark that it is made of
        plain = set()
        for w in missing:
            if w in old:
                new[w] = old[w]
                continue
            # the vocabulary is of lower case and splits a letter from a full stop or comma
            stem, mark = (w[:-1], w[-1]) if w[-1] in ".," and w[-2:-1].isalpha() else (w, "")
            if stem[0].isupper() and stem[0] < "\u0250" and stem[1:].islower() and stem.isalpha():
                stem = stem.lower()
            if stem != w:
                made[w] = stem, mark
            for x in (stem, mark):
                if x not in new:
                    if x in old:
                        new[x] = old[x]
                    else:
                        plain.add(x)
        self._encode(list(plain))
        for w, (stem, mark) in made.items():
            new[w] = new[stem] + new[mark]

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        found = list(map(self.new.get, words))
        if None in found:
            self._add({w for w, f in zip(words, found) if f is None})
            found = [self.old[w] if (f := self.new.get(w)) is None else f for w in words]
        return b"".join(found)


_CACHES: dict[str, WordCache] = {}  # of this Python worker, which runs many tasks


def cache_of(path: str) -> WordCache:
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


class Packer:
    """Windows of one task.  A piece is (doc, start, bytes, doc_tokens)."""

    def __init__(self, task: int, window: int = WINDOW, max_open: int = 4096):
        import numpy as np

        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, dtype=np.int64)  # open windows by fill level
        self.open: dict[int, list[list]] = {}  # level -> windows, each a list of pieces
        self.n_open, self.next_id = 0, task << 40
        self.done: list[tuple] = []

    def _close(self, pieces: list) -> None:
        at = 0
        for doc, start, data, tokens in pieces:
            n = len(data) // 4
            self.done.append((doc, start, n, zlib.crc32(data), tokens, self.next_id, at, data))
            at += n
        self.next_id += 1

    def _put(self, level: int, pieces: list, size: int) -> None:
        full = level + size
        if full == self.window:
            self._close(pieces)
        else:
            self.open.setdefault(full, []).append(pieces)
            self.counts[full] += 1
            self.n_open += 1

    def _take(self, level: int) -> list:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def best_level(self, size: int) -> int:
        """Level of the window to use (0: a new one): least change of the sum
        of squared counts; ties go to the fullest."""
        import numpy as np

        c, w = self.counts, self.window
        change = 2 * (c[size + 1 : w + 1] - c[1 : w + 1 - size]) + 2  # levels 1 .. w - size
        if len(change):
            change[-1] = 1 - 2 * c[w - size]  # a window that fills up leaves the counts
            change[c[1 : w + 1 - size] == 0] = np.iinfo(np.int64).max
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= 2 * c[size] + 1:
                return k + 1
        return 0

    def add(self, doc, data: bytes) -> None:
        w, tokens = 4 * self.window, len(data) // 4
        whole = len(data) - len(data) % w
        for at in range(0, whole, w):
            self._close([(doc, at // 4, data[at : at + w], tokens)])
        if whole < len(data):
            size = (len(data) - whole) // 4
            level = self.best_level(size)
            window = self._take(level) if level else []
            window.append((doc, whole // 4, data[whole:], tokens))
            self._put(level, window, size)
            if self.n_open > self.max_open:
                self.pour(last=False)

    def pour(self, last: bool = True) -> None:
        """Fill open windows from one another, cutting pieces; all but the one
        that is left over get full."""
        pieces = [p for level in sorted(self.open, reverse=True) for win in self.open[level] for p in win]
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        window, level = [], 0
        for doc, start, data, tokens in pieces:
            while data:
                n = min(len(data) // 4, self.window - level)
                window.append((doc, start, data[: 4 * n], tokens))
                start, data, level = start + n, data[4 * n :], level + n
                if level == self.window:
                    self._close(window)
                    window, level = [], 0
        if window:
            if last:
                self._close(window)
            else:
                self._put(0, window, level)


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, max_open: int = 4096,
         with_ids: bool = True) -> DataFrame:
    """Pieces of packed sequences, one row each: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and, on request, the ids."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    ship_package(docs.sparkSession)
    d = pick(docs, "doc_id", "text")
    schema = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, {SCHEMA}" + (", ids array<int>" if with_ids else "")

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        cache = cache_of(tokenizer)
        packer = Packer(TaskContext.get().partitionId(), window, max_open)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def out(id_type):
            rows, packer.done = packer.done, []
            cols = list(zip(*rows))
            arrays = [pa.array(cols[0], type=id_type)] + [pa.array(c, type=pa.int64()) for c in cols[1:7]]
            if with_ids:
                ids = [np.frombuffer(b, dtype="<i4") for b in cols[7]]
                arrays.append(pa.array(ids, type=pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        id_type = None
        for b in batches:
            id_type = b.column(0).type
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                packer.add(doc, cache.ids(text.as_py() or "") + END)
                if len(packer.done) >= 2000:
                    yield out(id_type)
        packer.pour()
        if packer.done:
            yield out(id_type)

    return d.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
