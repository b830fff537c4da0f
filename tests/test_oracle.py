"""Every registered query against its independent DuckDB SQL on the sf0.001 tables."""

import datetime as dt
import math

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E
from quartermart import catalog, oracle

TABLES = ["supplier", "nation", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else None
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF001)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(oracle.oracle_sql()[name])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert len(got) == len(want)
    assert _canon(got_cols, got) == _canon(want_cols, want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["year_quarter", "poi_id"]
    assert df.count() > 0
