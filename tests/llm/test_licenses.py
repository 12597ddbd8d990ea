"""Operator 4: signatures, comment boxes, base places against brute force, many hits."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from speechprep.llm import licenses

from .conftest import SCHEMA, TRICKY

ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
       "provided that the above copyright notice and this permission notice appear in all copies.")
MIT = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
CASES = [
    (ISC, "isc"), (MIT, "mit"), ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
    ("Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.", "apache"),
    ("You should have received a copy of the GNU Affero General Public License along with this program.", "agpl"),
    ("The Software shall be used for Good, not Evil.", "json"), ("Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", "unlicense"),
    ("Altered source versions must be plainly marked as such, and must not be misrepresented", "zlib"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License", "epl"),
    ("As a special exception, the copyright holders give you permission to link the code", "gpl-linking-exception"),
    ("Licensed under either of Apache License or MIT license at your option.", "dual"),
    ("Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives", "cc0"),
    ("may be distributed under the same terms as Perl itself.", "perl"),
]


def test_signatures_find_their_licence(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, (text, label) in enumerate(CASES):
        assert label in got[i], (text, got[i])


def test_every_signature_passes_its_own_gates():
    """What a signature must contain has its keyword and a word of the gate."""
    for _, _, rx in licenses.SIGNATURES:
        for found in licenses.runs(rx):
            assert any(g in x for g in licenses._GATE for x in found), rx
        assert all(len(k) >= 7 for k in licenses.literals(rx))
    assert licenses.literals(r"\bneither the names? of .{1,9}? nor (?:a|b) the x\b|\bab cd [12]\.0\b") == ["neither the name", "ab cd"]


@pytest.mark.parametrize("box", [
    lambda ls: "/" + "*" * 60 + "\n" + "".join(f" * {x}\n * {'*' * 20}\n" for x in ls) + " " + "*" * 60 + "/",
    lambda ls: "#" * 70 + "\n" + "".join(f"#   {x:<66}#\n" for x in ls) + "#" * 70,
    lambda ls: "".join(f";;;   {x}   ;;;\n\n\n\n" for x in ls),
    lambda ls: "<!--\n" + "".join(f"  --   {x}\n{' ' * 200}\n" for x in ls) + "-->",
    lambda ls: "".join(f"// {x}\n//{'/' * 77}\n" for x in ls),
])
def test_notices_in_comment_boxes_of_any_width(spark, box):
    rows = []
    for i, (text, _) in enumerate(CASES):
        words = text.split(" ")
        rows.append((i, box([" ".join(words[k:k + 4]) for k in range(0, len(words), 4)])))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, (text, label) in enumerate(CASES):
        assert label in got[i].labels.split(","), (rows[i], got[i].labels)
        for d in got[i].detections:  # places are those of the text as it stands
            assert 0 <= d.start < d.end <= len(rows[i][1])
    first = next(d for d in got[0].detections if d.label == "isc" and d.confidence > 0.9)
    assert re.sub(r"[\s*#/;!>-]+", "", rows[0][1][first.start:first.end]).lower().startswith(("permissiontouse", "distributethissoftware"))


def brute_base(text):
    words = [w.translate({k: k + 32 for k in range(65, 91)}) for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "") if w]
    out = []
    for label, phrase in licenses.BASE.items():
        out += [(i, label) for i in range(len(words)) if tuple(words[i:i + len(phrase)]) == phrase]
    at = [i for i, _ in out]
    return len(words), len(out), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in out}))


def test_base_columns_equal_brute_force(spark, texts, clashing):
    rnd = random.Random(5)
    bits = ["mit", "MIT", "license", "License", "apache", "general", "public", "é", "x", "licenses", "日本"]
    rows = [(10_000 + i, "".join(rnd.choice(bits) + rnd.choice([" ", "-", "\n", "_", "", "."]) for _ in range(rnd.randint(0, 40)))) for i in range(300)]
    rows += list(texts)
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert sorted(r.n_base for r in licenses.scan(clashing).collect()) == sorted(brute_base(t)[1] for _, t in TRICKY)


def test_suppression_equals_a_plain_loop(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(40):
        found = sorted((a := rnd.randint(0, 60), -(a + rnd.randint(1, 20)), -rnd.randint(1, 6), f"l{k}", 0.5) for k in range(rnd.choice([0, 1, 3, 40, 1500])))
        rows.append((i, found))
    df = spark.createDataFrame(rows, f"id int, every {licenses._DETECTION}")
    for r in df.select("every", licenses._suppress(F.col("every")).alias("kept")).collect():
        want = [x for k, x in enumerate(r.every) if not any(y.neg_priority <= x.neg_priority and y.neg_end <= x.neg_end for y in r.every[:k])]
        assert r.kept == want


def test_a_text_with_many_notices_takes_seconds(spark):
    text = "Released under the MIT License. See the Apache License 2.0.\n" * 50_000
    began = time.time()
    row = licenses.scan(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert row.n_base == 100_000 and len(row.detections) >= 100_000 and row.labels == "apache,mit"
    assert time.time() - began < 60
