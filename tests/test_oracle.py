"""Every registered key against its DuckDB oracle on sf0.001 (the driver's
gate runs the same comparison on sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import digest
from speechprep.fixtures import BASE_TABLES

from .conftest import SF

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_key(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if key not in SQL:
        assert df.columns and len(rows) >= 0
        return
    cur = con.execute(SQL[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["album", "total_ms", "n_readable", "n_files", "is_total", "hours"]
    assert df.count() > 0
