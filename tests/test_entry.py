"""The driver's contract: names, and queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from pricefold.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")


def cells(rows):
    return sorted(tuple("NULL" if v is None or v != v else repr(round(float(v), 9)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in sorted(os.listdir(SF)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5


@pytest.mark.parametrize("name", ["a2_deduplicated_items", "a3_history_conflicts", "a7_payer_rollup", "a13_procedure_stats", "q4_procedure_page", "a18_price_cohorts", "w6_best_sources", "w7_ranked_candidates", "j7_best_matches", "j9_consistent_names", "u6_index_upsert", "d13_file_findings", "d13_submission_findings", "d14_identity_candidates", "d8_regression_gate", "o2_first_by_lowest_rate", "q3_prices_with_total", "s18_generations", "u7_merged_states", "f8_money", "f11_prefixed_codes", "f18_url_flags", "f23_failure_reasons", "p3_directory_filters", "s1_ingest_tall", "t1_latest_states"])
def test_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({queries.SQL[name]})").fetchall()
    assert cells(df.select(*columns).collect()) == cells(want)


def test_payer_page_by_grade_has_every_facility(spark, tmp_path):
    """More facilities of a payer than a page of the largest ones shows."""
    money, day = "100.0D + id AS l_extendedprice", "timestamp'2024-01-01' AS l_shipdate"
    items = spark.range(700).selectExpr("8 * id AS l_orderkey", "11 * id + 4 AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", money, "0.1D AS l_discount", "'N' AS l_returnflag", "'O' AS l_linestatus", day)
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries.QUERIES["o8_payer_page_by_grade"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = con.execute(f"SELECT slug, ccn, place FROM ({queries.SQL['o8_payer_page_by_grade']})").fetchall()
    assert len(want) > 500 and cells(got) == cells(want)
