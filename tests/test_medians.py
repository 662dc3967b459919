"""Exact places with bounded state against sorted lists: hot keys, ties, few and no values."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from pricefold.functions import medians


def test_against_sorted_lists(spark, monkeypatch):
    monkeypatch.setattr(medians, "ACCURACY", 100)
    rng = random.Random(4)
    lists = {"hot": [rng.lognormvariate(3, 2) for _ in range(6000)], "tied": [5.0] * 3000 + [7.0] * 3001, "two": [1.0, 2.0], "one": [3.0], "mixed": [float(rng.randint(0, 9)) for _ in range(999)], "edge": [float(i) for i in range(101)]}
    df = spark.createDataFrame([(k, v) for k, vs in lists.items() for v in vs] + [("hot", None), ("none", None)], "k string, v double").repartition(5)
    got = {r.k: r for r in medians.exact_medians(df, ["k"], "v").collect()}
    want = {r.k: r for r in df.where("v IS NOT NULL").groupBy("k").agg(medians.upper_median("v").alias("u"), medians.true_median("v").alias("t")).collect()}
    assert set(got) == set(lists)
    for k, vs in lists.items():
        vs = sorted(vs)
        assert (got[k].n, got[k].upper_median) == (len(vs), vs[len(vs) // 2]) and got[k].upper_median == want[k].u
        assert abs(got[k].true_median - want[k].t) < 1e-9 and abs(got[k].true_median - (vs[(len(vs) - 1) // 2] + vs[len(vs) // 2]) / 2) < 1e-9
    shares = {"p5": 0.05, "p50": 0.5, "p95": 0.95}
    for r in medians.exact_shares(df, ["k"], "v", shares).collect():
        vs = sorted(lists[r.k])
        assert [r[p] for p in shares] == [vs[min(len(vs) - 1, int(len(vs) * s + 1e-9))] for s in shares.values()]
    assert medians.exact_medians(df.limit(0), ["k"], "v").count() == 0


def test_a_hot_key_is_not_one_list(spark, monkeypatch):
    """The second pass groups a small part of a hot key's distinct values."""
    monkeypatch.setattr(medians, "ACCURACY", 1000)
    df = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 200_000).cast("double").alias("v"))
    out = medians.exact_medians(df, ["k"], "v")
    assert out.first().true_median == 99999.5
    plan = out._jdf.queryExecution().optimizedPlan().toString()  # no aggregate keeps a list or a map of a key's values
    assert "collect_list" not in plan and "percentile_disc" not in plan and "percentile_approx" in plan
