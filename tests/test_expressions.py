"""Scalar expressions on typed-in literals."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pricefold.functions import expressions as X
from pricefold.functions.medians import at_share, true_median, upper_median
from pricefold.functions.payers import canon_payer, strip_method


def apply(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_money(spark):
    assert apply(spark, X.to_money, ["$1,234.50", " 7 ", "", "N/A", "-", "null", None, "5d", "1e3", "-2.5", ".5", "abc"]) == [1234.5, 7.0, None, None, None, None, None, None, 1000.0, -2.5, 0.5, None]


def test_code_types(spark):
    assert apply(spark, X.detect_code_type, ["99213", "J1234", "470", "12-3456", "12345678901", "A12.3", "abc", "", None]) == ["CPT", "HCPCS", "DRG", "MS-DRG", "NDC", "ICD-10", "CDM", "", ""]
    assert apply(spark, X.canon_code_type, ["cpt", "ms drg", "RC", "procedure code", "local", None]) == ["CPT", "MS-DRG", "REV", "", "LOCAL", ""]


@pytest.mark.parametrize(("code", "kind", "want"), [("CPT: 99213", "", ("99213", "CPT")), ("MS-DRG 470", None, ("470", "MS-DRG")), (" 99213 ", "", ("99213", "CPT")), ("X9", "local", ("X9", "LOCAL")), ("HCPCS#J1234", "CPT", ("J1234", "HCPCS")), (None, None, ("", ""))])
def test_normalize_code(spark, code, kind, want):
    df = spark.createDataFrame([(code, kind)], "c string, t string")
    r = df.select(X.normalize_code(F.col("c"), F.col("t")).alias("x")).first().x
    assert (r.code, r.code_type) == want


def test_display_code(spark):
    rows = [("", "", "A very long description of a thing", True), ("99213", "cpt", "", True), ("Q", "PERDIEM", "", True), ("Q", "PERDIEM", "", False), ("470", "code", "", True), (None, None, None, False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, t string, d string, p boolean")
    got = [tuple(r.x) for r in df.select("i", X.display_code_type(F.col("c"), F.col("t"), F.col("d"), F.col("p")).alias("x")).orderBy("i").collect()]
    assert got == [("A very long description of a thing", "CDM"), ("99213", "CPT"), ("Q", "CDM"), ("Q", "PERDIEM"), ("470", "DRG"), ("", "CDM")]


def test_payers(spark):
    names = ["Aetna PPO", "standard_charge|Blue Cross HMO", "negotiated_dollar_median_amount: Cigna", "BCBS Medicare Advantage", "Medicare", "Kaiser Northern CA", "VA CCN", "nova choice", "Self-Pay", "Acme Régional Gold", "", None, "CMS 12", "kp 4"]
    got = [r.slug for r in apply(spark, canon_payer, names)]
    assert got == ["aetna", "bcbs", "cigna", "medicare-advantage", "medicare", "kaiser", "va", "nova", "cash", "acme-regional", "unknown", "unknown", "cms-12", "kp-4"]
    assert apply(spark, strip_method, ["standard_charge|median_amount|X | Y"]) == ["X | Y"]
    assert apply(spark, canon_payer, ["acme regional plan"])[0].display == "Acme Regional"


def test_urls(spark):
    assert apply(spark, X.url_host, ["https://User@Www.A.org:8080/x?y", "mailto:a@b.c", None]) == ["www.a.org:8080", "", None]
    assert apply(spark, X.norm_url, ["https://urldefense.com/v3/__https://a.org/f.csv?x=1&amp;y=2__;!!k", " https://b.org "]) == ["https://a.org/f.csv?x=1&y=2", "https://b.org"]
    links = ["https://a.org/12-3_mercy_standardcharges.csv", "/page", "https://a.org/price-transparency", "https://a.org/x.zip"]
    assert apply(spark, lambda c: X.score_link(c, F.lit("Machine-readable file")), links) == [13, 2, 4, 5]
    assert apply(spark, X.is_web_asset, ["https://a.org/manifest.json?v=1", "https://a.org/favicon-16.png", "https://a.org/icons/x.json", "https://a.org/prices.json"]) == [True, True, True, False]
    assert apply(spark, X.is_protected_wrapper, ["https://urldefense.com/v3/x", "https://a.org/?u=urldefense.com", "https://x.urldefense.com./y", "ftp://urldefense.com"]) == [True, False, True, False]
    assert apply(spark, lambda c: X.is_rejected(c, F.lit("text/html")), ["https://a.org/f.csv", "https://a.org/view/f.csv", "https://a.org/guide.pdf"]) == [True, False, True]
    assert apply(spark, X.score_page_link, ["https://a.org/standardcharges.csv", "https://a.org/manifest.json", "https://drive.google.com/file/d/1/view"]) == [14, 0, -2]


def test_names_and_labels(spark):
    assert apply(spark, X.name_norm, ["The Mercy-Hospital of X, Inc.", None]) == ["mercy hospital x", ""]
    assert [sorted(x) for x in apply(spark, X.name_signature, ["Mercy Medical Center Mercy North", ""])] == [["mercy", "north"], []]
    assert "https://www.mercynorth.org" in apply(spark, X.name_domains, ["Mercy North"])[0]
    assert apply(spark, X.slugify, ["  Crème  Brûlée_(x)--y ", "", None, "!!"]) == ["creme-brulee-x-y", "unknown", "unknown", "unknown"]
    df = spark.createDataFrame([(95, True), (80, False), (79, None), (60, True), (59, True), (None, None)], "s int, b boolean")
    assert [r[0] for r in df.select(X.grade_for(F.col("s"))).collect()] == ["A", "B", "C", "D", "F", "F"]
    assert [r[0] for r in df.select(X.status_label(F.col("b"))).collect()] == ["pass", "fail", "unknown", "pass", "pass", "unknown"]
    assert apply(spark, X.failure_reason, ["no_live_mrf", "seed:-:probe_html:x", "timeout:60", "0.4s", None]) == ["no_live_mrf_after_rediscovery", "mrf_url_returns_html_wrapper", "mrf_fetch_timeout", "hard_failure", "hard_failure"]
    assert apply(spark, X.is_hard_failure, ["no_live_mrf", "seed:-:probe_html:x", "x:timeout:60", "0.4s", None]) == [True, True, True, False, False]


def test_medians(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10)], "x double")
    r = df.agg(upper_median("x").alias("u"), true_median("x").alias("t"), at_share("x", 0.25).alias("q")).first()
    assert (r.u, r.t, r.q) == (3.0, 2.5, 2.0)
