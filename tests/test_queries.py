"""Registered queries against their DuckDB oracle SQL (the driver's gate)."""

import duckdb
import pytest

import __spark_entry__ as E
from chatmill.plans.catalog import QUERIES
from chatmill.sources.tables import TABLES

from .conftest import SF0001

_rows = {}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted(tuple(repr(norm(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_rows = cur.fetchall()
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(s_rows, df.columns) == _canon(d_rows, d_cols)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.count() > 0 and "retention_pct" in out.columns
