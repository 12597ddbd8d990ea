"""Registry of named queries: key → (Spark builder, DuckDB oracle SQL).

A builder takes a :class:`~speechprep.fixtures.Tables` and returns a
DataFrame; the oracle is plain SQL over the driver's tables with the
fixture views inlined as a ``WITH`` clause.  Keys without an oracle are
checked rows-only by the driver and by unit tests here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Tables, duckdb_with


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, views: tuple[str, ...] | list[str] = (), sql: str | None = None):
    """Register a builder under ``key`` with an optional oracle ``sql``."""

    def deco(fn: Callable[[Tables], DataFrame]):
        oracle = duckdb_with(list(views), sql) if sql is not None else None
        REGISTRY[key] = Query(key, fn, oracle)
        return fn

    return deco


def _load_all() -> None:
    from . import q_catalog, q_crawl, q_files, q_names, q_packing, q_segments, q_signal, q_stream  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: (lambda spark, sf_dir, _q=q: _q.build(Tables(spark, sf_dir))) for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: q.oracle for k, q in REGISTRY.items() if q.oracle is not None}
