"""Operator 12: held-out accuracy, the FTRL update, defined cases."""

import collections
import math
import zlib

import numpy as np

from speechprep.llm import classify
from speechprep.llm.queries import QUERIES

from .conftest import SCHEMA, SF, TRICKY

LABELS = "doc_id long, quality int, toxic int"


def auc(y, score):
    pos, neg = [s for a, s in zip(y, score) if a], [s for a, s in zip(y, score) if not a]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_held_out_documents_are_told_apart(spark):
    d = SF.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in QUERIES["op12_quality_classifier"](spark, d).collect()}
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    held = [k for k in labels if k in rows and rows[k].held_out]
    assert auc([labels[k] for k in held], [rows[k].score for k in held]) > 0.97
    assert np.mean([rows[k].predicted == labels[k] for k in held]) > 0.95


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", 1 - labels.quality).where(classify.held_out(labels.doc_id))
    other = labels.where(~classify.held_out(labels.doc_id)).select(flipped.columns).unionByName(flipped)
    a, b = classify.fit(docs, labels), classify.fit(docs.repartition(7), other.repartition(3))
    assert a.any() and (a == b).all()  # nor does the way the rows are dealt out


def test_one_update_is_ftrl_proximal():
    rnd = np.random.default_rng(1)
    m = classify.Ftrl(8, rate=0.3, smooth=1.0, l1=0.01, l2=0.1)
    z, n = [0.0] * 9, [0.0] * 9
    for _ in range(50):
        at = sorted(rnd.choice(8, 3, replace=False).tolist())
        x = rnd.random(3).astype(np.float32)
        y = float(rnd.random() < 0.5)
        w = {}
        for i in [*at, 8]:
            w[i] = 0.0 if abs(z[i]) <= 0.01 else -(z[i] - math.copysign(0.01, z[i])) / ((1 + math.sqrt(n[i])) / 0.3 + 0.1)
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip([*at, 8], [*x.tolist(), 1.0]))))
        for i, v in zip([*at, 8], [*x.tolist(), 1.0]):
            g = (p - y) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.3 * w[i]
            n[i] += g * g
        m.learn(np.array(at, np.int32), x, y)
    assert np.allclose(m.z, z) and np.allclose(m.n, n)


def test_features_of_a_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97} X{i % 5}, the 12" for i in range(3000))
    whole = classify.features(text)
    monkeypatch.setattr(classify, "BLOCK", 1000)
    parts = classify.features(text)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])
    assert math.isclose(float((parts[1] ** 2).sum()), 1, rel_tol=1e-4)
    assert len(classify.features("x" * 5000)[0]) > 0


def test_defined_cases(spark, tricky, clashing, empty):
    labels = spark.createDataFrame([(6, 0, 0), (9, 1, 0), (9, 1, 0), (10, 1, 1), (11, 0, 0), (12, None, 0), (None, 1, 0)], LABELS)
    for docs in (tricky, clashing):
        rows = classify.score(docs, classify.fit(docs, labels)).collect()
        assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, _ in TRICKY)
        assert all(0 <= r.score <= 1 for r in rows)
        same = collections.defaultdict(set)
        for r in rows:
            same[r.doc_id].add(r.score)
        assert len(same[4]) == 1  # a repeated row
    none = classify.fit(tricky, spark.createDataFrame([], LABELS))
    assert {r.score for r in classify.score(tricky, none).collect()} == {0.5}
    assert classify.score(empty, none).count() == 0
    assert classify.score(spark.createDataFrame([(1, ""), (2, None)], SCHEMA), none).count() == 2


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3000)], LABELS)
    n = classify.examples(docs, labels, max_rows=300).count()
    assert 200 < n < 400
