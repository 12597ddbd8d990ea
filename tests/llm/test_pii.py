"""Operator 10: anchored aggregation by kind, overlaps, redaction, long rows of spans."""

import collections
import random
import time

import pytest
from pyspark.sql import functions as F

from speechprep.llm import pii

from .conftest import SCHEMA, SF, TRICKY


def test_base_spans_are_believed_for_every_kind(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet").select("text")
    rows = pii.written(docs.select(pii.described(F.col("text")).alias("found")).where(F.size("found") > 0), "test-pii")
    model = pii.fit_spans(rows)
    n = collections.defaultdict(lambda: [0.0, 0])
    for r in rows.select(F.explode("found").alias("x")).select("x.kind", "x.base", "x.votes").groupBy("kind", "base", "votes").count().collect():
        if r.base:
            n[r.kind][0] += r["count"] * model["chances"][pii.KINDS[r.kind]][r.votes]
            n[r.kind][1] += r["count"]
    assert set(n) >= {0, 1, 2, 3} and all(p / m > 0.9 for p, m in n.values())
    assert all(0.3 < x["prior"] <= 1 for k, x in model["kinds"].items() if k in ("email", "ip", "phone"))


def test_reliabilities_of_several_planted_kinds():
    rnd = random.Random(4)
    right = {"email": (0.95, 0.9, 0.85, 0.8, 0.7), "card": (0.9, 0.7, 0.95, 0.6, 0.85), "phone": (0.8, 0.95, 0.75, 0.9, 0.65)}
    share = {"email": 0.7, "card": 0.2, "phone": 0.5}
    counts, said = {}, collections.defaultdict(collections.Counter)
    for kind, rates in right.items():
        counts[kind] = collections.Counter()
        for _ in range(6000):
            z = rnd.random() < share[kind]
            votes = ["0"]
            for j, rate in enumerate(rates, 1):
                vote = "0" if rnd.random() < 0.3 else "+" if (rnd.random() < rate) == z else "-"
                votes.append(vote)
                if vote != "0":
                    said[kind, j, z][vote] += 1
            base = z and rnd.random() < 0.5
            counts[kind][("y+" if base else "0") + "".join(votes[1:])] += 1
    p, model = pii.em_kinds(counts)
    for kind in right:
        assert abs(model[kind]["prior"] - share[kind]) < 0.06
        for j in range(1, 6):
            got = model[kind]["labelers"][pii.LABELERS[j]]
            for z, v, name in ((True, "+", "yes_if_true"), (False, "-", "no_if_false")):
                measured = said[kind, j, z][v] / said[kind, j, z].total()
                assert abs(got[name] - measured) < 0.1, (kind, j, z)


def test_few_candidates_follow_the_common_table():
    counts = {"email": {"y+++++0": 300, "0---0-0"[:6]: 300}, "name": {"0+0+00": 2, "0-0-00": 2}}
    p, _ = pii.em_kinds(counts)
    assert p["name"]["0+0+00"] > 0.8 > 0.2 > p["name"]["0-0-00"]
    assert pii.em_kinds({}) == ({}, {})


def test_secrets_are_added_and_plain_runs_are_not(spark):
    rnd = random.Random(2)
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    docs = [(i, f'of token = "{h}" here') for i, h in enumerate(hexes)]
    docs += [(100 + i, f"mail ann{i}@example.org and call +1 (212) 555-01{i:02d}") for i in range(60)]
    docs += [(200 + i, f"x=item-{'-'.join(str(k) for k in range(i, i + 9))}-of-the-list") for i in range(60)]
    got = {r.doc_id: r.spans for r in pii.detect(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert all(got[i] == "secret:12:52" for i in range(60))
    assert not any("secret" in got[200 + i] for i in range(60))


def plain_apart(spans):
    return [x for x in spans if x[2] or not any(b[2] and b[0] < x[1] and x[0] < b[1] for b in spans)]


def test_overlaps_and_redaction_equal_plain_loops(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(60):
        text = "".join(rnd.choice("ab é日\n") for _ in range(rnd.choice([0, 5, 3000])))
        spans = []
        for _ in range(rnd.choice([0, 1, 5, 700])):
            a = rnd.randint(0, len(text))
            spans.append((0, a, rnd.randint(a, min(len(text), a + 9)), "", "", rnd.random() < 0.5))
        rows.append((i, text, spans))
    df = spark.createDataFrame(rows, f"id int, text string, spans {pii._SPAN}")
    for r in df.select("spans", pii._apart(F.col("spans")).alias("got")).collect():
        key = lambda x: (x[0], x[1], x[2])
        assert sorted(key((x.start, x.end, x.base)) for x in r.got) == sorted(plain_apart([(x.start, x.end, x.base) for x in r.spans]))


def test_redaction_of_dense_spans_equals_a_plain_loop(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a@b.cd ", "x" * rnd.randint(1, 3000), " 1.2.3.4", "é日𝄞 ", "+1 (212) 555-0100 "]) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    model = {"weights": {}, "bias": -1.0}
    spans = {r.doc_id: r.spans for r in pii.detect(docs, model).collect()}
    for r in pii.redact(docs, model).collect():
        out, at, text = "", 0, texts[r.doc_id]
        for a, b, k in sorted((int(x.split(":")[1]), int(x.split(":")[2]), x.split(":")[0]) for x in spans[r.doc_id].split(",") if x):
            if a >= at:
                out += text[at:a] + f"[{k.upper()}]"
            at = max(at, b)
        assert r.text == out + text[at:]


@pytest.mark.parametrize("piece", ["ann{}@example.com, ", "id 300.{}.1.1 or ", "call (212) 555-0{} x "])
def test_a_text_with_a_hundred_thousand_spans(spark, piece):
    text = "".join(piece.format(100 + k % 900) for k in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "ann@example.com 300.1.1.1")], SCHEMA)
    began = time.time()
    row = pii.detect(docs).where("doc_id = 1").first()
    clean = pii.redact(docs, {"weights": {}, "bias": -1.0}).where("doc_id = 1").first().text
    assert time.time() - began < 60
    if "@" in piece:
        assert row.n_email == 100_000 and clean == "[EMAIL], " * 100_000


def test_detect_with_clashing_columns(spark, tricky, clashing):
    a, b = ({(r.doc_id, r.base_sha256, r.spans) for r in pii.detect(d).collect()} for d in (tricky, clashing))
    assert a == b and pii.detect(clashing).count() == len(TRICKY)
