"""Every registered query against its DuckDB twin, on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "customer", "lineitem", "part"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float) and math.isnan(x):
            return None
        return x
    return sorted((tuple(repr(v(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    drows, dcols = res.fetchall(), [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm(rows, df.columns) == _norm(drows, dcols)


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 21 and df.count() > 0
