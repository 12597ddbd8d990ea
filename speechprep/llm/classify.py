"""Operator 12: quality classifier on hashed word n-grams.

A text is a stream of words: runs of letters, of digits or of other marks.
Each word has a form (lower case) and a shape (capitals, digits, kind of
mark); a text's features are its form unigrams and bigrams and its shape
bigrams (which also tell whether a word repeats the one before) and trigrams,
hashed into ``2 ** bits`` slots.  A slot found ``c``
times among ``n`` has the value ``sqrt(c / n)``, so that every text has length
one and long texts weigh as much as short ones.

The model is a logistic regression trained by follow-the-regularised-leader
(proximal) updates, one example at a time in a seeded order that changes from
epoch to epoch.  An epoch is one Spark job: the examples stream through the
trainer, which holds one batch and the two arrays of the model.  A score is the
sparse dot product of a text's features and the weights, squashed to 0 .. 1.

Training uses a seeded sample of about ``max_rows`` labelled documents, of
those whose crc32(doc_id as text) mod 3 is not 1; all others are only scored.
The sample's ids are the one thing that is broadcast (12 bytes each), and the
model (4 bytes a slot).  Every document is scored on its whole text, in blocks
of ``BLOCK`` characters, so memory does not grow with its length.

Defined cases: null and empty texts consist of the two ends of a text only;
a word cut by the end of a block without any white space counts as two; several
labels of one doc_id count as their mean (half or more is 1), null labels and
labels of null ids not at all; without labels of both kinds every score is 0.5
(predicted 1); null doc_ids are held out; repeated rows get equal scores; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import pick, table, written

BITS = 18
BLOCK = 1 << 20
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_M = (1 << 64) - 1
_KNOWN: dict[str, bytes] = {}  # hashes of form and shape, of this Python worker


def _shape(word: str) -> str:
    if word[0].isalpha():
        return "X" if word.isupper() and len(word) > 1 else "Xx" if word[0].isupper() else "x"
    return "0" if word[0].isdigit() else f"{word[0]}{min(len(word), 4)}"


def _hashes(words: list[str]):
    """Two arrays of 64-bit hashes: forms and shapes."""
    import numpy as np
    import xxhash

    found = list(map(_KNOWN.get, words))
    if None in found:
        if len(_KNOWN) > 500_000:
            _KNOWN.clear()
        for k, w in enumerate(words):
            if found[k] is None:
                h = _KNOWN.get(w)
                if h is None:
                    h = xxhash.xxh64_digest(w.lower().encode("utf-8", "surrogatepass")) + xxhash.xxh64_digest(
                        _shape(w).encode("utf-8", "surrogatepass"), seed=1)
                    if len(w) < 64:
                        _KNOWN[w] = h
                found[k] = h
    both = np.frombuffer(b"".join(found), dtype=np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _blocks(text: str) -> Iterator[str]:
    """The text in blocks that end at white space where there is some."""
    at = 0
    while len(text) - at > BLOCK:
        end = at + BLOCK
        cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
        end = cut if cut > at else end
        yield text[at:end]
        at = end
    yield text[at:]


def features(text: str | None, bits: int = BITS):
    """Sorted slots of a whole text and their values (unit length)."""
    import numpy as np

    end = np.array([1], np.uint64)  # both ends of a text are words
    odd = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
    form, shape = end, end  # the last words before the block
    slots, counts, n = None, None, 0
    text = text or ""
    blocks = _blocks(text)
    last = next(blocks)
    while last is not None:
        block, last = last, next(blocks, None)
        f, s = _hashes(_WORD.findall(block)) if block else (end[:0], end[:0])
        tail = end if last is None else end[:0]
        f, s = np.concatenate([form, f, tail]), np.concatenate([shape, s, tail])
        k = len(form)  # words that were counted already
        h = np.concatenate([
            f[k:] * odd[0],
            f[k - 1 : -1] * odd[1] + f[k:] * odd[2],
            s[k - 1 : -1] * odd[3] + s[k:] * odd[4] + (f[k - 1 : -1] == f[k:]).astype(np.uint64),
            s[:-2] * odd[2] + s[1:-1] * odd[5] + s[2:] * odd[0] if len(s) > 2 else end[:0],
        ])
        h = (h ^ (h >> np.uint64(31))) * odd[5]
        got, c = np.unique((h >> np.uint64(64 - bits)).astype(np.int32), return_counts=True)
        n += len(h)
        if slots is None:
            slots, counts = got, c
        else:
            slots, where = np.unique(np.concatenate([slots, got]), return_inverse=True)
            counts = np.bincount(where, weights=np.concatenate([counts, c]), minlength=len(slots))
        form, shape = f[-2:], s[-2:]
    return slots, np.sqrt(counts / max(1, n)).astype(np.float32)


class Ftrl:
    """Logistic regression by FTRL-proximal: ``z`` and ``n`` by slot, and a bias."""

    def __init__(self, size: int, state: tuple[bytes, bytes] | None = None, rate: float = 0.5, smooth: float = 1.0,
                 l1: float = 0.002, l2: float = 0.01):
        import numpy as np

        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2
        zero = np.zeros(size + 1)  # the last slot is the bias
        self.z, self.n = (np.frombuffer(x).copy() for x in state) if state else (zero, zero.copy())

    def weights(self, at=slice(None)):
        import numpy as np

        z, n = self.z[at], self.n[at]
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.smooth + np.sqrt(n)) / self.rate + self.l2)

    def learn(self, slots, values, y: float) -> None:
        import numpy as np

        at, x = np.append(slots, len(self.z) - 1), np.append(values, np.float32(1))
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.rate * w
        self.n[at] = n + g * g


def sigmoid(x: float) -> float:
    from math import exp

    return 1 / (1 + exp(-x)) if x > -700 else 0.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def examples(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000, seed: int = 5,
             bits: int = BITS) -> DataFrame:
    """h (seeded order), y, slots, values of the sampled training documents."""
    named = pick(labels, "doc_id", label).toDF("doc_id", "label").where("doc_id IS NOT NULL AND label IS NOT NULL")
    usable = named.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("y"))
    usable = usable.withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
    share = min(1.0, max_rows / max(1, usable.count()))
    chosen = written(usable.where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20))), "classifier-sample")

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            got = [features(t.as_py(), bits) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([
                b.column("h"), b.column("y"), pa.array([s.tobytes() for s, _ in got], pa.binary()),
                pa.array([v.tobytes() for _, v in got], pa.binary())], ["h", "y", "slots", "values"])

    # the sample has max_rows rows but for chance, whatever the tables hold
    rows = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "h", "y")
    return written(rows.mapInArrow(run, "h long, y int, slots binary, values binary"), "classifier-examples")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000, epochs: int = 3, seed: int = 5,
        bits: int = BITS):
    """Weights by slot (float32, the bias last); all zero unless both labels occur."""
    import numpy as np

    ship_package(docs.sparkSession)
    found = examples(docs, labels, label, max_rows, seed, bits)
    if found.select("y").distinct().count() < 2:
        return np.zeros((1 << bits) + 1, np.float32)
    state: tuple | None = None
    for epoch in range(epochs):

        def run(batches, state=state) -> Iterator:
            import pyarrow as pa

            model = Ftrl(1 << bits, state)
            for b in batches:
                for y, s, v in zip(b.column("y").to_pylist(), b.column("slots"), b.column("values")):
                    model.learn(np.frombuffer(s.as_py(), np.int32), np.frombuffer(v.as_py(), np.float32), y)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (model.z, model.n)], ["z", "n"])

        order = F.xxhash64(F.lit(epoch), "h")
        one = found.coalesce(1).sortWithinPartitions(order, "h", "slots").mapInArrow(run, "z binary, n binary")
        state = tuple(map(bytes, one.first()))
    return Ftrl(1 << bits, state).weights().astype(np.float32)


def score(docs: DataFrame, weights) -> DataFrame:
    """doc_id, score (0 to 1), one row per input row."""
    spark = docs.sparkSession
    ship_package(spark)
    bits = (len(weights) - 1).bit_length() - 1
    shared = spark.sparkContext.broadcast(weights)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        w = shared.value
        for b in batches:
            out = []
            for t in b.column(1):
                s, v = features(t.as_py(), bits)
                out.append(sigmoid(float(np.dot(w[s].astype(np.float64), v)) + float(w[-1])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    d = pick(docs, "doc_id", "text")
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
