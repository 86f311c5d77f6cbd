"""Driver contract: entry() runs, every query has a DuckDB oracle match at sf0.001."""
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "min_age" in df.columns and "max_age" in df.columns


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in order)) for r in df.collect())
    idx = [ocols.index(c) for c in order]
    exp = sorted(repr(tuple(_norm(row[i]) for i in idx)) for row in res.fetchall())
    assert got == exp
