"""A training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read back as the next stage's documents.  All but the last
stage return the columns of documents: quality rules drop rows, exact and near
duplicates keep one row of each group, personal data is replaced in the text,
and the last stage packs what is left into sequences (one row a piece).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from speechprep.llm import exact_dedup, jaccard, packing, pii, quality
from speechprep.llm.common import table, written

STAGES = [
    ("quality", lambda spark, docs, sf_dir: quality.filter_docs(docs)),
    ("exact_dedup", lambda spark, docs, sf_dir: exact_dedup.filter_docs(docs)),
    ("near_dedup", lambda spark, docs, sf_dir: jaccard.filter_docs(docs)),
    ("pii", lambda spark, docs, sf_dir: pii.redact(docs)),
    ("packing", lambda spark, docs, sf_dir: packing.pack(docs, with_ids=False)),
]

#: The tokenizer and the trained span classifier are beyond SQL; the tests hold
#: the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's table lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
