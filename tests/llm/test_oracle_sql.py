"""The registered operators against their DuckDB SQL."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = con.execute(entry.oracle_sql()[key])
    columns = [c[0] for c in found.description]
    got = entry.queries()[key](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(found.fetchall())


def test_all_operators_are_registered():
    names = {k.split("_")[0] for k in entry.queries() if k.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)}
