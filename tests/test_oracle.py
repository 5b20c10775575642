"""Every registered query with SQL equals its DuckDB oracle (rows, columns, values)."""

import math

import pytest

from quench.plans.catalog import QUERIES

from conftest import SF_SMALL

SQL_QUERIES = sorted(n for n, q in QUERIES.items() if q.sql)


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_oracle(spark, duck, name):
    q = QUERIES[name]
    df = q.run(spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(q.oracle())
    cols = [d[0] for d in cur.description]
    want = _rows(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_every_query_has_a_runner():
    import __spark_entry__ as E

    assert set(E.queries()) == set(QUERIES) | set(E.LLM_QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())
