"""Passes of inference as one resumable run (B3 + B4 + I1 + C2).

Each pass takes the clips its rule selects that have no result yet, runs its
model, and commits results as a new version of one bucketed table
(:mod:`upsert_table`), a chunk of clips at a time.  A clip whose model failed is
committed with its error and no text; a later pass that selects it takes it
again.  A run that died is started again with the same arguments and goes on
with what is not committed; a run that is complete does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import upsert_table
from .ordered import materialize

SCHEMA = "path string, text string, error string, pass int"


@dataclass(frozen=True)
class Pass:
    """``select`` says which clips the pass may take (a condition over their
    columns); ``infer`` maps clips to rows (path, output, error)."""

    number: int
    select: Column
    infer: Callable[[DataFrame], DataFrame]


def two_passes(duration: str, short: Callable, long: Callable, split_ms: int = 30_000) -> list[Pass]:
    """Pass 1 takes clips up to ``split_ms``, pass 2 those from ``split_ms`` on,
    so a clip of exactly that length goes to both if the first one fails.
    Clips without a duration are taken by none."""
    d = F.col(duration)
    return [Pass(1, d <= split_ms, short), Pass(2, d >= split_ms, long)]


def results(spark, root: str) -> DataFrame:
    """(path, text, error, pass) of all clips that some pass has taken."""
    return upsert_table.read(spark, root, SCHEMA)


def pending(clips: DataFrame, root: str, step: Pass) -> DataFrame:
    """Clips that ``step`` still has to take: selected, without a text, and not
    tried by this pass or a later one."""
    found = results(clips.sparkSession, root)
    settled = found.where(F.col("text").isNotNull() | (F.col("pass") >= step.number)).select("path")
    return clips.where(step.select).join(settled, "path", "left_anti")


def run(clips: DataFrame, root: str, steps: list[Pass], chunks: int = 4, buckets: int = 64) -> list[dict]:
    """Run the passes in order.  Returns one report a committed chunk: pass,
    chunk, version, changed.

    A chunk is a fixed share of the paths (by hash); what a crash loses is the
    chunk it falls into.  Of a path given twice one row is taken.  The clips
    that some pass may take are written once, as every chunk reads them."""
    spark, done = clips.sparkSession, []
    clips = materialize(clips.where(reduce(or_, [step.select for step in steps], F.lit(False))))
    chunk_of = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(chunks))
    for step in steps:
        for k in range(chunks):
            todo = pending(clips, root, step).where(chunk_of == k).dropDuplicates(["path"])
            out = step.infer(todo).select("path", F.col("output").cast("string").alias("text"), "error", F.lit(step.number).alias("pass"))
            report = upsert_table.upsert(out, root, "path", buckets)
            if report["changed"]:
                done.append({"pass": step.number, "chunk": k, **report})
    return done
