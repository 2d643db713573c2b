"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from lapsewise import oracle

from .conftest import SF001

TABLES = ["customer", "orders", "lineitem", "events", "supplier", "nation"]


def norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def rows(cols, data):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return sorted((tuple(norm(r[i]) for i in idx) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows(dcols, cur.fetchall())
