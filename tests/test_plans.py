"""Queries whose plans must not make the items anew for each use."""

from __future__ import annotations

import __spark_entry__
from pricefold.sources import delimited, files


def test_payer_facilities_standardize_once(spark):
    """Statistics and scores of one query come from items that were written once (F24)."""
    plan = __spark_entry__.queries()["a9_payer_facilities"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan


def test_wide_rows_are_filtered_by_their_cells(spark):
    """The filter of wide rows doesn't work out codes, and prefixed, odd and blank codes come out as before (F15)."""
    raw = spark.createDataFrame([("CPT: 99213", "a", "1"), (" drg 470", "b", ""), ("", "c", "$1,000.50"), ("", "", "5"), ("", "d", "n/a"), (" X9 ", "", "")], "Code string, Description string, `Gross Charge` string")
    out = files.ingest_wide(raw)
    filters = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
    assert not any("regexp_extract" in x for x in filters)
    assert sorted((r.code, r.code_type, r.gross) for r in out.collect() if r.gross is None) == [("470", "DRG", None), ("X9", "CDM", None)]
    assert sorted((r.code, r.code_type, r.gross) for r in out.collect() if r.gross is not None) == [("", "", 1000.5), ("99213", "CPT", 1.0)]


def test_profiles_count_rows_once(spark):
    """Shares of each position from one reading of the rows, short rows too (F6)."""
    rows = spark.createDataFrame([("f", ["a", "1"]), ("f", ["", "x"]), ("f", ["b"]), ("g", ["", "$2"])], "file string, cells array<string>")
    df = delimited.column_profiles(rows)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert {r.file: [(x.at, round(x.filled, 3), x.prices) for x in r.profile] for r in df.collect()} == {"f": [(0, 0.667, 0.0), (1, 0.667, 0.5)], "g": [(0, 0.0, 0.0), (1, 1.0, 1.0)]}
