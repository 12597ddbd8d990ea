"""Registered queries: oracles, the pipeline, the entry without the subpackage."""

import collections
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from speechprep.llm import packing
from speechprep.llm.queries import ORACLES, QUERIES

from .conftest import SF
from .test_documents import base_spans, brute_components, check_packing

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_all_are_registered():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    cur = con.execute(ORACLES[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    got = collections.Counter(tuple(r) for r in df.select(*cols).collect())
    assert got == collections.Counter(cur.fetchall())


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES) - {"op9_html_extraction"}))
def test_query_covers_every_document(spark, texts, key):
    ids = [r.doc_id for r in QUERIES[key](spark, SF).select("doc_id").distinct().collect()]
    assert sorted(ids) == sorted(d for d, _ in texts)


def test_pipeline_against_brute_force(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op1_quality_rules']}) WHERE kept").fetchall()}
    stages, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stages.append(corpus_pipeline.written(stage(spark, stages[-1], SF), f"test-{name}"))
        if name != "packing":
            assert stages[-1].columns == columns
    rows = [[(r.doc_id, r.text) for r in s.collect()] for s in stages[:5]]
    assert {d for d, _ in rows[1]} == kept
    first = {}
    for d, t in sorted(rows[1]):
        first.setdefault(" ".join(t.replace("\n", " ").split(" ")), d)
    norm = lambda t: __import__("re").sub(r"[\x20\x09-\x0D]+", " ", t)
    groups = collections.defaultdict(list)
    for d, t in rows[1]:
        groups[norm(t)].append(d)
    assert {d for d, _ in rows[2]} == {min(g) for g in groups.values()}
    comps = brute_components(rows[2])
    assert {d for d, _ in rows[3]} == {d for d, n, c in comps if n == 0 or d == c}
    for (d, before), (e, after) in zip(sorted(rows[3]), sorted(rows[4])):
        assert d == e and not base_spans(after)
        if not base_spans(before):
            assert before == after
    pieces = stages[5].collect()
    check_packing(rows[4], pieces)
    assert collections.Counter(r.doc_id for r in packing.pack(stages[4]).collect()).keys() == {r.doc_id for r in pieces}


def test_entry_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op1_') for k in q), set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[1:] == ["False", "True"]
