"""Registered queries of this subpackage against their SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

from pricefold.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want))
