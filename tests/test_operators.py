"""Operators on small typed-in tables."""

from __future__ import annotations

from functools import reduce

import pytest
from pyspark.sql import functions as F

from pricefold.operators import indexes, matching, merges, quality, registry, search, standardize

ITEM = "ccn string, seq long, code string, code_type string, description string, setting string, billing_class string, gross double, cash double, min_rate double, max_rate double, history boolean, payers array<struct<payer:string,rate_dollar:double>>"


def items(spark):
    pay = lambda *r: [{"payer": p, "rate_dollar": x} for p, x in r]
    return spark.createDataFrame([
        ("000001", 1, "99213", "CPT", "Visit", "op", "f", 100.0, 60.0, 1.0, 2.0, False, pay(("Aetna PPO", 50.0))),
        ("000001", 2, "99213", "CPT", "Visit again", "op", "f", 100.0, None, None, None, False, pay(("Aetna PPO", 70.0), ("Cigna", 0.0), ("Humana", 90.0))),
        ("000001", 3, "99214", "CPT", "Dated", "op", "f", 10.0, None, None, None, True, []),
        ("000001", 4, "99214", "CPT", "Dated otherwise", "op", "f", 11.0, None, None, None, False, pay(("Cigna", 5.0))),
        ("000001", 5, "", "", "No code but a price", "op", "f", 0.0, None, None, None, False, []),
        ("000001", 6, "X1", "PERDIEM", "Vendor", "op", "f", None, 5.0, None, None, False, []),
        ("000001", 7, "99215", "CPT", "No price", "op", "f", None, None, None, None, False, []),
        ("000002", 8, "99213", "CPT", "Visit", "op", "f", 120.0, 6000.0, None, None, False, []),
        ("000003", 9, "99213", "CPT", "Visit", "op", "f", 90.0, 55.0, None, None, True, []),
    ], ITEM)


def test_standardization(spark):
    df = items(spark)
    counts = {r.ccn: r for r in standardize.skipped_counts(df).collect()}
    assert (counts["000001"].n_raw, counts["000001"].n_usable, counts["000001"].no_price) == (7, 6, 1)
    slim = standardize.slim(df)
    rows = {(r.ccn, r.code): r for r in slim.collect()}
    assert set(rows) == {("000001", "99213"), ("000001", "No code but a price"), ("000001", "X1"), ("000002", "99213"), ("000003", "99213")}
    best = rows["000001", "99213"]
    assert best.desc == "Visit again" and [(x.p, x.r) for x in best.top] == [("Humana", 90.0), ("Aetna PPO", 70.0)] and best.pc == 3
    assert rows["000001", "X1"].type == "CDM"
    again = standardize.deduplicated(standardize.deduplicated(standardize.usable(df)).withColumn("seq", F.col("seq")))
    assert again.count() == standardize.deduplicated(standardize.usable(df)).count()
    assert {(r.ccn, r.code) for r in standardize.conflicts(standardize.usable(df)).collect()} == {("000001", "99214")}
    scores = {r.ccn: (r.score, r.grade) for r in standardize.compliance(slim, spark.createDataFrame([("000001",), ("000009",)], "ccn string")).collect()}
    assert scores["000009"] == (0, "F") and scores["000001"] == (35, "F")
    assert standardize.compliance(slim).where("ccn = '000003'").first().score == 65


def test_indexes(spark):
    slim = standardize.slim(items(spark))
    entries = indexes.code_entries(slim)
    flagged = {r.ccn: r.quality for r in indexes.with_outliers(entries).collect()}
    assert flagged == {"000001": "missing", "000002": "normal", "000003": "low"}
    stats = indexes.with_canonical(indexes.payer_stats(slim))
    roll = {r.slug: r for r in indexes.payer_rollup(stats).collect()}
    assert set(roll) == {"aetna", "humana"} and roll["aetna"].aliases == ["Aetna PPO"]
    assert [r.slug for r in indexes.featured_payers(indexes.payer_rollup(stats), ["humana"]).collect()] == ["humana"]
    packed = indexes.packed_entries(indexes.top_entries(entries, 2)).first()
    assert [e.ccn for e in packed.entries] == ["000002", "000001"]
    ranked = indexes.ranked_codes(indexes.code_coverage(entries), 1)
    assert all(r.ok for r in quality.top_k_exact(indexes.code_coverage(entries), ranked).collect())


def test_regression_gate_and_upsert(spark):
    old = spark.createDataFrame([("1", 5), ("2", 3), ("3", 0), ("4", 7)], "ccn string, n long")
    new = spark.createDataFrame([("1", 5), ("2", 0), ("3", 2), ("5", 1)], "ccn string, n long")
    diff = {r.ccn: (r.n, r.diff) for r in merges.upserted(old, new).collect()}
    assert diff == {"1": (5, "same"), "2": (0, "n to 0"), "3": (2, "0 to n"), "4": (7, "kept"), "5": (1, "added")}
    once = merges.upserted(old, new).drop("diff")
    assert sorted(map(tuple, merges.upserted(once, new).drop("diff").collect())) == sorted(map(tuple, once.collect()))
    gate = {r.check_id: (r.ok, r.observed) for r in quality.regression_gate(old, once, new).collect()}
    assert gate == {"updated missing": (True, "0"), "updated without prices": (False, "1"), "lost": (True, "0"), "turned to zero": (False, "1")}
    assert {(r.ccn, r.side) for r in merges.index_diff(old, new).collect()} == {("4", "live only"), ("5", "local only")}
    a, b = (spark.createDataFrame(x, "path string, sha256 string") for x in ([("a", "1"), ("b", "1")], [("a", "1"), ("c", "1")]))
    assert {(r.path, r.state) for r in merges.drift(a, b).collect()} == {("a", "same"), ("b", "vanished"), ("c", "new")}
    one = spark.createDataFrame([(1, 2)], "x int, y int")
    over = merges.overlaid(one, spark.createDataFrame([(9,)], "x int"), []).first()
    assert (over.x, over.y) == (9, 2)


def test_cohorts_fail_closed(spark):
    reg = spark.createDataFrame([("A00001", True), ("A00002", True), ("A00003", True), ("A00004", False), ("A00005", True)], "ccn string, required boolean")
    best = spark.createDataFrame([("A00001",), ("A00002",), ("A00003",), ("A00004",)], "ccn string")
    index = spark.createDataFrame([("A00001", 9), ("A00002", 0), ("A00004", 4), ("A00005", 6), ("B00001", 2)], "ccn string, n long")
    c = registry.price_cohorts(reg, best, index)
    r = c.first()
    assert (r.cohort, r.cohort_priced, r.cohort_zero, r.cohort_unindexed, r.priced_outside, r.indexed_unknown) == (3, 1, 1, 1, 3, 1)
    assert all(x.ok for x in quality.cohort_checks(c, c).collect())
    wrong = quality.cohort_checks(c, c.withColumn("cohort", F.lit(8)))
    assert [x.check_id for x in wrong.where("NOT ok").collect()] == ["cohort"]
    bad = spark.createDataFrame([("A 0001", "n", "s", True), ("A00002", "", "s", None)], "ccn string, name string, state string, required boolean")
    assert {x.check_id: x.observed for x in quality.registry_checks(bad).collect()} == {"ccn": "1", "name": "1", "state": "0", "flags": "1"}


def test_matching(spark):
    cases = spark.createDataFrame([("c1", "OR", "The Mercy Hospital", "Salem"), ("c2", "OR", "Mercy North Clinic", "salem"), ("c3", "OR", "Unrelated", "Salem"), ("c4", "WA", "Mercy Hospital", "Salem")], "case_id string, block string, name string, city string")
    facilities = spark.createDataFrame([("f1", "OR", "Mercy Hospital", "Bend"), ("f2", "OR", "Mercy North Pavilion", "Salem")], "ccn string, block string, name string, city string")
    got = {r.case_id: (r.ccn, r.strength) for r in matching.best_matches(cases, facilities).collect()}
    assert got == {"c1": ("f1", 100), "c2": ("f2", 55)}
    sources = spark.createDataFrame([("Mercy North", "https://mercy.org/x"), ("Zeta", "https://mercy.org")], "name string, url string")
    assert [(r.hits, r.any_hit) for r in matching.words_in_url(sources).collect()] == [(1, True), (0, False)]


def test_submissions(spark):
    reg = spark.createDataFrame([("000001", "Mercy North Hospital", "OR", "Salem"), ("000002", "Grace South Hospital", "WA", "Kent")], "ccn string, name string, state string, city string")
    sub = spark.createDataFrame([("a", "000001", "Mercy North", "OR", None, None), ("b", "000001", "Grace South", None, None, None), ("c", "000001", "Mercy North", "WA", None, None), ("d", "000001", None, "OR", None, None), ("e", "000001", "Mercy North", None, None, None), ("f", "999999", "Mercy North", "OR", None, None), ("g", "000001", "Mercy North", None, None, "77")], "submission_id string, ccn_claimed string, hospital_name string, state string, city string, license string")
    got = {r.submission_id: r.verdict for r in quality.identity_verdicts(sub, reg).collect()}
    assert got == {"a": "VERIFIED", "b": "MISMATCH", "c": "MISMATCH", "d": "UNVERIFIABLE", "e": "UNVERIFIABLE", "f": "UNVERIFIABLE", "g": "VERIFIED"}
    assert {(r.submission_id, r.named) for r in quality.misassigned(sub, reg).collect()} == {("b", "000002"), ("f", "000001")}
    seeds = spark.createDataFrame([("000001", "Northern Valley Health"), ("000001", None), ("000001", "Northern Valley Health")], "ccn string, name string")
    cells = spark.createDataFrame([
        ("a", "000001", "Northern Valley Health", "OR", None, None, None), ("b", "000001", None, None, None, "9", ["version", None, "Mercy North Hospital"]), ("c", "000001", "", "OR", None, None, ["Other House"]),
        ("d", "000001", "Grace South", "OR", None, None, ["Mercy North Hospital"]), ("e", None, "Mercy North", "OR", None, None, []), ("f", "000001", " ", "WA", None, None, ["Valley Northern Health"]),
    ], "submission_id string, ccn_claimed string, hospital_name string, state string, city string, license string, meta_cells array<string>")
    got = {r.submission_id: r.verdict for r in quality.identity_verdicts(cells, reg, seeds).collect()}
    assert got == {"a": "VERIFIED", "b": "VERIFIED", "c": "UNVERIFIABLE", "d": "MISMATCH", "e": "UNVERIFIABLE", "f": "MISMATCH"}
    assert {r.submission_id: r.verdict for r in quality.identity_verdicts(cells, reg).collect()}["a"] == "MISMATCH"
    heads = spark.createDataFrame([("a", "3.0.0", "M", "c", "s", "1", "2025-01-01"), ("b", "2.0", "", None, "s", None, "x")], "submission_id string, version string, hospital_name string, city string, state string, license string, last_updated_on string")
    found = {(r.submission_id, r.rule) for r in quality.header_findings(heads).collect()}
    assert found == {("b", x) for x in ("version-not-current", "hospital-name-missing", "hospital-address-missing", "license-missing", "last-updated-invalid")}


def test_wave_states(spark):
    """Merged from states alone: as merged from all entries, with ties, equal rows and no charges; a facility twice is an error."""
    rows = [(f"c{i % 4}", f"f{i % 7}", None if i % 5 == 0 else float(i % 3), float(i % 2), "b", "s") for i in range(80)]
    x = spark.createDataFrame(rows, "code string, ccn string, gross double, cash double, bc string, s string")
    shards = [x.where(F.col("ccn").isin(*ids)) for ids in (["f0", "f3"], ["f1", "f2", "f6"], ["f4", "f5"], ["none"])]
    states = [merges.wave_state(df, 6) for df in shards]
    codes, owners = (reduce(lambda a, b: a.unionByName(b), [st[j].withColumn("wave", F.lit(i)) for i, st in enumerate(states)]) for j in (0, 1))
    packed = lambda df: {(r.code, r.n_entries, r.facilities, str(r.entries)) for r in df.collect()}
    assert packed(merges.merged_states(codes, owners, 3, 6)) == packed(merges.merged_waves(shards, 3, 6)) and len(packed(merges.merged_states(codes, owners, 3, 6))) == 3
    with pytest.raises(Exception, match="in several shards"):
        merges.merged_states(codes, owners.unionByName(spark.createDataFrame([("f1", 0)], "ccn string, wave int")), 3, 6).collect()


def test_submission_findings(spark):
    paid = "array<struct<payer: string, rate_dollar: double, methodology: string>>"
    items = spark.createDataFrame([
        ("1", i, f"c{i}", t, "out", f"item {i}" if i != 2 else None, None, None, None, None, []) for i, t in enumerate(["CPT", "x", "x", "y", "z", "q", "r", None])
    ] + [("1", 9, "c9", "cpt", "out", "same", 1.0, 2.0, None, None, [("A", 1.0, " "), ("A", 2.0, None), ("B", 3.0, "fee")]), ("1", 10, "c9", "cpt", "out", "same", 0.0, None, None, None, None), ("9", 1, "c", "CPT", "out", "of no file", None, None, None, None, [])],
        f"ccn string, seq long, code string, code_type string, setting string, description string, gross double, cash double, min_rate double, max_rate double, payers {paid}")
    heads = spark.createDataFrame([("1", "csv", None, None, None, None, None, None, 11), ("2", "json", "3.0.0", "M", "c", "s", "1", "2025-01-01", None), ("3", "json", "2.0", "M", "c", "s", "1", "2025-01-01", 0)], "ccn string, format string, version string, hospital_name string, city string, state string, license string, last_updated_on string, source_count long")
    got = {tuple(r) for r in quality.submission_findings(heads, items).collect()}
    assert got == {
        ("1", "error", "completeness-mismatch", "11", 10), ("1", "info", "coverage", "1 priced, 2 payers", 10), ("1", "error", "items-without-prices", "item 0; item 1; c2; item 3; item 4", 9),
        ("1", "warning", "gross-charge-missing", None, 9), ("1", "warning", "discounted-cash-missing", None, 9), ("1", "warning", "payer-rates-missing", None, 9), ("1", "warning", "methodology-missing", None, 2),
        ("1", "warning", "duplicate-items", None, 1), ("1", "warning", "code-type-unrecognized", "X", 2), *[("1", "warning", "code-type-unrecognized", t, 1) for t in ("", "Q", "R", "Y")],
        ("2", "error", "no-items", None, None), ("3", "error", "version-not-current", None, None), ("3", "error", "no-items", None, None),
    }
    assert quality.submission_findings(heads.limit(0), items.limit(0)).count() == 0


def test_procedure_pages(spark):
    rows = spark.createDataFrame([("c", "1", "b", "s", 5.0, 3.0, 9.0), ("c", "2", "b", "s", None, None, None), ("c", "3", "b", "s", 4.0, 2.0, 30.0), ("d", "1", "b", "s", 1.0, None, None)], "code string, ccn string, bc string, s string, gross double, payer_min double, payer_max double")
    facilities = spark.createDataFrame([("1", "n", "OR")], "ccn string, name string, state string")
    assert [(r.ccn, r.total) for r in search.procedure_prices(rows, facilities, " c", 2).collect()] == [(None, 0)] and [(r.ccn, r.total) for r in search.procedure_prices(rows.withColumn("code", F.upper("code")), facilities, " c", 2).collect()] == [("3", 3), ("1", 3)]
    beyond = search.procedure_prices(rows.withColumn("code", F.upper("code")), facilities, "c", 2, 50).collect()
    assert [(r.ccn, r.total) for r in beyond] == [(None, 3)]
    assert {(r.code, r.ccn, r.place) for r in search.first_of_procedures(rows, "payer", 2).collect()} == {("c", "3", 1), ("c", "1", 2), ("d", "1", 1)}
    assert [r.ccn for r in search.ordered_procedure(rows, "payer").collect()] == ["3", "1", "2", "1"]


def test_registry_and_search(spark):
    probes = spark.createDataFrame([("1", "u", 1, 5, 200, True), ("1", "u", 2, 6, 404, False), ("2", "v", 1, 7, -1, False)], "ccn string, mrf_url string, probed_at long, event_id long, http_status int, alive boolean")
    assert {(r.ccn, r.http_status) for r in registry.latest_probes(probes).collect()} == {("1", 404), ("2", -1)}
    fails = spark.createDataFrame([("1", "timeout:60", "log1", 2), ("1", "no_live_mrf", "log2", 1), ("2", "0.4s", "log1", 1)], "ccn string, error string, log string, at int")
    got = {r.ccn: (r.logs, r.reasons) for r in registry.failures_by_facility(fails).collect()}
    assert got["1"] == (2, ["no_live_mrf_after_rediscovery", "mrf_fetch_timeout"])
    gap, history = probes.select("ccn").distinct(), registry.probe_history(probes)
    assert [(r.ccn, r.reason) for r in merges.terminal_exceptions(gap, fails, probes.select("ccn").where("ccn = '9'"), history).collect()] == [("1", "mrf_fetch_timeout")]
    reg = spark.createDataFrame([("000001", "Alpha", "OR", "Salem"), ("000002", "Beta Alpha", "OR", "Alphaville"), ("000003", "Gamma", "WA", "Kent")], "ccn string, name string, state string, city string")
    assert [(r.name, r.score) for r in search.search_facilities(reg, "alpha").collect()] == [("Alpha", 80), ("Beta Alpha", 60)]
    assert [r.name for r in search.search_facilities(reg, "000003").collect()] == ["Gamma"]
    assert [r.ccn for r in search.page(reg, ["ccn"], 1, 1).collect()] == ["000002"] and search.page(reg, ["ccn"], -5).count() == 1
    rows = spark.createDataFrame([("c", "1", "b", "s", "missing", None, 10.0, "x"), ("c", "2", "b", "s", "normal", 30.0, 10.0, "y"), ("c", "3", "b", "s", "normal", 12.0, 10.0, None)], "code string, ccn string, bc string, s string, quality string, cash double, median_cash double, state string")
    assert [r.ccn for r in search.ordered_procedure(rows).collect()] == ["3", "2", "1"] and [r.ccn for r in search.ordered_procedure(rows, "cash desc").collect()] == ["2", "3", "1"]
    pay = spark.createDataFrame([("a", "1", 5, 2.0, "F", "x"), ("a", "2", 9, None, "A", "y")], "slug string, ccn string, n_items int, median double, grade string, state string")
    assert [[r.ccn for r in search.ordered_payer_page(pay, k).collect()] for k in ("items", "median", "grade", "state")] == [["2", "1"], ["1", "2"], ["2", "1"], ["1", "2"]]


def test_normalized_claims(spark):
    claims = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "metric string, claimed long")
    facts = spark.createDataFrame([("a", 1), ("b", 5)], "metric string, value long")
    assert {r.subject: r.ok for r in quality.claim_audit(claims, facts).collect()} == {"a": True, "b": False, "c": True}
    twice = quality.duplicate_keys(claims.union(claims), "metric", "claims").first()
    assert not twice.ok and twice.observed == "3 a"
    assert quality.failure_rate(spark.createDataFrame([(None,), ("x",)], "error string")).first().ok is False


def test_prefix_filtered_joins_against_all_pairs(spark):
    """Every pair of names compared in full, over thresholds; a word that all names have makes no pairs of its own."""
    import random

    from pricefold.functions import expressions as X
    from pricefold.operators import matching

    rng = random.Random(8)
    words = [f"word{i}" for i in range(12)]
    name = lambda: " ".join(["common", *rng.sample(words, rng.randint(0, 5))])
    left, right = [(i, name()) for i in range(60)], [(1000 + i, name()) for i in range(60)]
    sides = [spark.createDataFrame(x, "id long, name string") for x in (left, right)]
    sets = [{r.id: set(r.s) for r in df.select("id", X.name_signature(F.col("name")).alias("s")).collect()} for df in sides]
    for percent in (20, 50, 80, 100):
        want = {}
        for i, a in sets[0].items():
            found = [(len(a & b) / len(a | b), -j, len(a & b), len(a | b)) for j, b in sets[1].items() if a & b and 100 * len(a & b) >= percent * len(a | b)]
            if found:
                _, j, common, total = max(found)
                want[i] = (-j, common, total)
        assert {r.l_id: (r.r_id, r.common, r.total) for r in matching.jaccard_matches(*sides, percent).collect()} == want
    got = {(r.l_id, r.r_id) for r in matching.consistent_names(*sides).collect()}
    assert got == {(i, j) for i, a in sets[0].items() for j, b in sets[1].items() if min(len(a), len(b)) >= 2 and (a <= b or b <= a)}


def test_copies_of_names_are_joined_as_one(spark, monkeypatch):
    """Names that compare alike make one row of the join, whatever their number; results name every copy."""
    from pricefold.operators import matching

    joined = []
    pairs = matching._prefix_pairs
    monkeypatch.setattr(matching, "_prefix_pairs", lambda a, b, *how: joined.append((a.count(), b.count())) or pairs(a, b, *how))
    left = spark.range(300).selectExpr("id", "if(id % 2 = 0, 'Mercy North Clinic', 'Clinic north mercy') AS name")
    right = spark.range(1000, 1400).selectExpr("id", "'Mercy North Pavilion' AS name")
    got = matching.jaccard_matches(left, right).collect()
    assert sorted(r.l_id for r in got) == list(range(300)) and {(r.r_id, r.common, r.total) for r in got} == {(1000, 2, 4)}
    cases = left.selectExpr("id AS case_id", "'OR' AS block", "name", "if(id % 3 = 0, NULL, 'Salem') AS city")
    got = {r.case_id: (r.ccn, r.strength) for r in matching.best_matches(cases, right.selectExpr("id AS ccn", "'OR' AS block", "name", "'salem' AS city")).collect()}
    assert got == {i: (1000, 55 if i % 3 else 40) for i in range(300)}
    assert joined == [(1, 1), (4, 1)]


def test_consistent_groups(spark):
    """Links by classes stand for the same pairs of names as the expanded ones."""
    from pricefold.operators import matching

    left = spark.createDataFrame([(1, "Mercy North"), (2, "north mercy"), (3, "Mercy North Clinic"), (4, "Grace South"), (5, "Mercy")], "id long, name string")
    right = spark.createDataFrame([(11, "Mercy North Pavilion"), (12, "North Mercy"), (13, "Mercy north"), (14, None)], "id long, name string")
    got = {tuple(r) for r in matching.consistent_groups(left, right).collect()}
    assert got == {
        ("pair", 1, 11, 2), ("pair", 1, 12, 4), ("pair", 3, 12, 2), ("left", 1, 1, 3), ("left", 2, 1, 3), ("left", 3, 3, 2), ("left", 4, 4, 0), ("left", 5, None, 0),
        ("right", 11, 11, 2), ("right", 12, 12, 3), ("right", 13, 12, 3), ("right", 14, None, 0),
    }
    assert sum(r[3] for r in got if r[0] == "pair") == matching.consistent_names(left, right).count() == 8


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_priced_code_types(spark):
    """The short form gives what the full one gives, for every label, shape and text."""
    from itertools import product

    from pricefold.functions import expressions as X

    codes = ["", " ", None, "99213", "J0001", "470", "1-22", "X1", " 00004 "]
    types = ["", None, "cpt", "MS_DRG", "ms drg", "LOCAL", "code", "CPT_HCPCS", "rc", "CDM", "_"]
    df = spark.createDataFrame(list(product(codes, types, ["", None, " Item 1 "])), "code string, code_type string, description string")
    full = X.display_code_type(F.col("code"), F.col("code_type"), F.col("description"), F.lit(True))
    df = df.select("*", full.alias("full"), X.priced_code_type(F.col("code"), F.col("code_type"), F.col("description")).alias("short"))
    named = df.where("trim(coalesce(code, '')) <> '' OR trim(coalesce(description, '')) <> ''")
    assert named.count() > 200 and named.where("NOT full <=> short").count() == 0


def test_items_are_standardized_once(spark):
    """One sort for ranks and conflicts, one shuffle for a document's two levels, and no second pass for names or medians."""
    from pricefold.operators import indexes, standardize

    schema = "ccn string, seq long, code string, code_type string, description string, setting string, billing_class string, gross double, cash double, min_rate double, max_rate double, history boolean, payers array<struct<payer:string,rate_dollar:double>>"
    row = lambda i, gross, n: ("000001", i, "99213", "CPT", "Visit", "O", "N", gross, 100.0 + i, None, None, False, [("Aetna PPO", 5.0 + k) for k in range(n)])
    items = spark.createDataFrame([row(1, 7.0, 1), row(2, 7.0, 2), row(3, 9.0, 2)], schema)
    slim = standardize.slim(items)
    plan = plan_of(slim)
    assert plan.count(" Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert [(r.gross, r.pc) for r in slim.collect()] == [(7.0, 2)]
    document = standardize.normalized_document(items)
    assert plan_of(document).count("Exchange hashpartitioning") == 1 and [len(r.charges) for r in document.collect()] == [3]
    stats = indexes.with_canonical(indexes.payer_stats(slim))
    assert plan_of(stats).count("Window [row_number") == 1 and [r.slug for r in stats.collect()] == ["aetna"]
    for df in (indexes.with_outliers(indexes.code_entries(slim)), indexes.hot_code_stats(indexes.code_entries(slim))):
        assert "Window [row_number" not in plan_of(df) and df.count() == 1


def made_from(df) -> str:
    """What a result's plan reads: a source that was written once before isn't in it."""
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dear_inputs_are_made_once(spark):
    """Differences of sets and merged waves read what was written, not their inputs again for each use (F13, F8)."""
    sets = [spark.range(a, b).select(F.col("id").cast("string").alias("ccn")) for a, b in ((0, 4), (1, 6), (3, 5))]
    gaps = merges.gap_sets(*sets)
    assert "Range (" not in made_from(gaps)
    assert sorted((r.gap, r.ccn) for r in gaps.collect()) == [("parsed - preview", "1"), ("parsed - preview", "2"), ("parsed - preview", "5"), ("target - parsed", "0"), ("target - preview", "0"), ("target - preview", "1"), ("target - preview", "2")]
    x = spark.range(40).select(F.format_string("c%d", F.col("id") % 3).alias("code"), F.format_string("f%d", F.col("id") % 4).alias("ccn"), F.col("id").cast("double").alias("gross"), F.lit(1.0).alias("cash"), F.lit("b").alias("bc"), F.lit("s").alias("s"))
    merged = merges.merged_waves([x.where("ccn < 'f2'"), x.where("ccn >= 'f2'")], 2, 3)
    assert "Range (" not in made_from(merged)
    assert {r.code: (r.n_entries, r.facilities, [e.gross for e in r.entries]) for r in merged.collect()} == {"c0": (14, 4, [39.0, 36.0, 33.0]), "c1": (13, 4, [37.0, 34.0, 31.0])}


def test_one_order_serves_ranks_and_conflicts(spark):
    """Ranks and conflicts come from one operator (F18, F20, F21, F23)."""
    df = standardize.without_conflicts(standardize.usable(items(spark)))
    assert made_from(df).count("Window [") == 1
    assert {r.seq for r in df.collect()} == {2, 5, 6, 8, 9}
