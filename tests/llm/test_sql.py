"""Queries that SQL can express, against DuckDB."""

import pytest
from conftest import SF001

from quartermart.llm import queries as Q


def canon(cols, rows):
    at = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(([r[i] for i in at] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = Q.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(Q.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got and canon(df.columns, got) == canon(cols, cur.fetchall())


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))
