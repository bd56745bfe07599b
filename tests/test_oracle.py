"""Every registered query that has a DuckDB oracle, on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) >= set(E.QUERIES)
    assert set(E.queries()) >= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "order_count", "total_sales"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, res.fetchall())
