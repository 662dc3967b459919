"""Data-quality gates. Each gives rows (check_id, subject, ok, observed, expected); a run passes if all are ok."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions import expressions as X
from pricefold.operators import matching
from pricefold.operators.indexes import code_coverage

CCN = r"^[0-9A-Z]{6}$"
# Code types that the template names, and the template's version.
KNOWN_TYPES = ["CPT", "HCPCS", "ICD", "ICD-10", "DRG", "MS-DRG", "R-DRG", "S-DRG", "APS-DRG", "AP-DRG", "APR-DRG", "APC", "NDC", "LOCAL", "EAPG", "HIPPS", "CDT", "RC", "CDM", "TRIS-DRG", "CMG", "MS-LTC-DRG"]
VERSION = "3.0.0"


def checks(one_row: DataFrame, subject: str, tests: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Turns one row of numbers into check rows: {check_id: (ok, observed, expected)}."""
    rows = [F.struct(F.lit(k).alias("check_id"), F.lit(subject).alias("subject"), F.coalesce(ok, F.lit(False)).alias("ok"), got.cast("string").alias("observed"), want.cast("string").alias("expected")) for k, (ok, got, want) in tests.items()]
    return one_row.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def zero(c: str) -> tuple[Column, Column, Column]:
    return F.col(c) == 0, F.col(c), F.lit(0)


def equal(a: Column, b: Column) -> tuple[Column, Column, Column]:
    return a == b, a, b


def registry_checks(registry: DataFrame) -> DataFrame:
    bad = lambda c: F.count_if(~F.coalesce(c, F.lit(False)))
    one = registry.agg(bad(F.col("ccn").rlike(CCN)).alias("ccn"), bad(F.trim("name") != "").alias("name"), bad(F.trim("state") != "").alias("state"), F.count_if(F.col("required").isNull()).alias("flags"))
    return checks(one, "registry", {k: zero(k) for k in ("ccn", "name", "state", "flags")})


def duplicate_keys(df: DataFrame, key: str, subject: str) -> DataFrame:
    """Duplicate keys fail the run; the sample names the smallest of them."""
    twice = df.groupBy(key).count().where("count > 1").agg(F.count("*").alias("n"), F.min(F.col(key).cast("string")).alias("least"))
    return checks(twice, subject, {"duplicates": (F.col("n") == 0, F.concat_ws(" ", "n", "least"), F.lit("0"))})


def summary_checks(summary: DataFrame) -> DataFrame:
    c = F.col
    return checks(summary, "summary", {
        "required within total": (c("required") <= c("total"), c("required"), c("total")),
        "compliant within required": (c("compliant") <= c("required"), c("compliant"), c("required")),
        "missing": equal(c("missing"), c("required") - c("compliant")),
        "missing with cases": (c("missing_with_cases") <= F.least("missing", "under_enforcement"), c("missing_with_cases"), F.least("missing", "under_enforcement")),
        "share": (F.abs(1000 * c("compliant") - c("compliant_per_mille") * c("required")) <= c("required"), c("compliant_per_mille"), F.floor(1000 * c("compliant") / F.greatest("required", F.lit(1)))),
    })


def cohort_checks(cohorts: DataFrame, again: DataFrame) -> DataFrame:
    """Identities within the cohort numbers, and agreement with the same numbers derived anew."""
    c = F.col
    inner = checks(cohorts, "cohorts", {
        "parts of the cohort": equal(c("cohort_priced") + c("cohort_zero") + c("cohort_unindexed"), c("cohort")),
        "priced": equal(c("cohort_priced") + c("priced_outside"), c("indexed_priced")),
        "indexed": (c("indexed_priced") <= c("indexed"), c("indexed_priced"), c("indexed")),
    })
    names = cohorts.columns
    both = cohorts.select(F.struct(*names).alias("a")).crossJoin(again.select(F.struct(*names).alias("b")))
    return inner.unionByName(checks(both, "cohorts again", {n: (F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")), F.col(f"a.{n}"), F.col(f"b.{n}")) for n in names}))


def index_totals(index: DataFrame, slim: DataFrame) -> DataFrame:
    a = index.agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("priced"))
    b = slim.agg(F.count_distinct("ccn").alias("facilities"), F.count("*").alias("items"))
    return checks(a.crossJoin(b), "index", {"rows": equal(F.col("rows"), F.col("facilities")), "items": equal(F.col("n"), F.col("items")), "priced": equal(F.col("priced"), F.col("facilities"))})


def item_checks(slim: DataFrame, index: DataFrame) -> DataFrame:
    """Every item: code, type, finite prices; and as many items as the index says for every facility."""
    odd = lambda c: F.coalesce(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), F.lit(False))
    one = slim.agg(F.count_if(F.coalesce(F.col("code") == "", F.lit(True))).alias("codes"), F.count_if(~F.coalesce(F.col("type").isin(X.DISPLAY_TYPES), F.lit(False))).alias("types"), F.count_if(odd("gross") | odd("cash") | odd("min") | odd("max")).alias("money"))
    counts = slim.groupBy("ccn").agg(F.count("*").alias("found")).join(index.select("ccn", "n"), "ccn", "full_outer")
    off = counts.agg(F.count_if(~F.col("found").eqNullSafe(F.col("n"))).alias("counts"))
    return checks(one, "items", {k: zero(k) for k in ("codes", "types", "money")}).unionByName(checks(off, "items", {"counts": zero("counts")}))


def code_index_checks(packed: DataFrame, most_codes: int, most_entries: int) -> DataFrame:
    one = packed.agg(F.count("*").alias("codes"), F.max(F.size("entries")).alias("longest"), F.count_if(F.exists("entries", lambda e: e["ccn"].isNull())).alias("shapeless"))
    return checks(one, "code index", {"codes": (F.col("codes") <= most_codes, F.col("codes"), F.lit(most_codes)), "entries": (F.coalesce("longest", F.lit(0)) <= most_entries, F.col("longest"), F.lit(most_entries)), "shape": zero("shapeless")})


def regression_gate(before: DataFrame, after: DataFrame, updated: DataFrame) -> DataFrame:
    """Updated facilities are there and priced, none is lost, none turns from priced to nothing; growth is welcome."""
    df = before.select("ccn", F.col("n").alias("a")).join(after.select("ccn", F.col("n").alias("b")), "ccn", "full_outer").join(updated.select("ccn", F.lit(True).alias("u")).distinct(), "ccn", "full_outer")
    u, a, b = F.coalesce("u", F.lit(False)), F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    one = df.agg(
        F.count_if(u & F.col("b").isNull()).alias("updated missing"), F.count_if(u & F.col("b").isNotNull() & (b <= 0)).alias("updated without prices"),
        F.count_if(F.col("a").isNotNull() & F.col("b").isNull()).alias("lost"), F.count_if((a > 0) & F.col("b").isNotNull() & (b <= 0)).alias("turned to zero"),
    )
    return checks(one, "index", {c: zero(c) for c in one.columns})


def parse_gates(target: DataFrame, parsed: DataFrame, known: DataFrame, most_missing: int = 20, most_empty: int = 5) -> DataFrame:
    """At most 20 % of the targets are missing, at most 5 % parsed to nothing; known cases don't count."""
    wanted = target.select("ccn").join(known.select("ccn"), "ccn", "left_anti")
    df = wanted.join(parsed.select("ccn", "n"), "ccn", "left")
    one = df.agg(F.count("*").alias("total"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") == 0).alias("empty"))
    return checks(one, "wave", {"missing": (100 * F.col("missing") <= most_missing * F.col("total"), F.col("missing"), F.col("total")), "empty": (100 * F.col("empty") <= most_empty * F.col("total"), F.col("empty"), F.col("total"))})


def code_format_gate(entries: DataFrame, live: DataFrame, most_codes: int = 25, most_percent: int = 2) -> DataFrame:
    """Codes have five letters or digits; codes outside the live set are only counted."""
    by = code_coverage(entries).join(live.select("code", F.lit(1).alias("l")).distinct(), "code", "left")
    bad = ~F.col("code").rlike("^[A-Z0-9]{5}$")
    one = by.agg(F.count_if(bad).alias("codes"), F.coalesce(F.sum(F.when(bad, F.col("n_entries"))), F.lit(0)).alias("rows"), F.sum("n_entries").alias("total"), F.count_if(~bad & F.col("l").isNull()).alias("outside"))
    return checks(one, "codes", {"codes": (F.col("codes") <= most_codes, F.col("codes"), F.lit(most_codes)), "rows": (100 * F.col("rows") <= most_percent * F.col("total"), F.col("rows"), F.col("total")), "outside": (F.lit(True), F.col("outside"), F.lit("any"))})


def top_k_exact(coverage: DataFrame, ranked: DataFrame) -> DataFrame:
    """No code outside the top k has more entries than the last one inside."""
    least = ranked.agg(F.min("n_entries").alias("least"))
    most = coverage.join(ranked.select("code"), "code", "left_anti").agg(F.coalesce(F.max("n_entries"), F.lit(0)).alias("most"))
    return checks(least.crossJoin(most), "codes", {"boundary": (F.col("most") <= F.coalesce("least", F.lit(0)), F.col("most"), F.col("least"))})


def manifest_checks(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Every listed output exists with its bytes and hash: one row for each."""
    df = manifest.select("path", F.struct("bytes", "sha256").alias("a")).join(found.select("path", F.struct("bytes", "sha256").alias("b")), "path", "left")
    text = lambda c: F.concat_ws(" ", F.col(f"{c}.bytes").cast("string"), F.col(f"{c}.sha256"))
    return df.select(F.lit("output").alias("check_id"), F.col("path").alias("subject"), F.col("a").eqNullSafe(F.col("b")).alias("ok"), text("b").alias("observed"), text("a").alias("expected"))


def file_findings(items: DataFrame, order: str = "seq", examples: int = 5, kinds: int = 5) -> DataFrame:
    """(ccn, severity, rule, detail, n) about the items of each file; rules without a case give no row.

    Detail: of items without prices, the descriptions (else codes) of the first ``examples`` by ``order``; of unknown code
    types, the type, one row for each of the ``kinds`` most frequent (ties by type); of the coverage, priced items and
    payers. Rates without a methodology are counted where the items' payers have that field."""
    gone = lambda c: F.coalesce(F.col(c), F.lit(0.0)) == 0
    unpaid = F.coalesce(F.size("payers"), F.lit(0)) < 1
    priceless = gone("gross") & gone("cash") & gone("min_rate") & gone("max_rate") & unpaid
    has_methods = "methodology" in items.schema["payers"].dataType.elementType.names
    methods = F.sum(F.greatest(F.lit(0), F.size(F.filter("payers", lambda x: F.trim(F.coalesce(x["methodology"], F.lit(""))) == "")))) if has_methods else F.lit(0).cast("long")
    one = items.groupBy("ccn").agg(
        F.count("*").alias("coverage"), F.count_if(priceless).alias("items-without-prices"), F.count_if(gone("gross")).alias("gross-charge-missing"),
        F.count_if(gone("cash")).alias("discounted-cash-missing"), F.count_if(unpaid).alias("payer-rates-missing"), methods.alias("methodology-missing"),
    )
    named = items.select("ccn", F.explode("payers.payer").alias("payer")).where("payer <> ''").distinct().groupBy("ccn").agg(F.count("*").alias("named"))
    nth = F.row_number().over(Window.partitionBy("ccn").orderBy(order, "description", "code"))
    label = F.coalesce(X.blank_to_null(F.col("description")), X.blank_to_null(F.col("code")), F.lit("?"))
    first = items.where(priceless).select("ccn", nth.alias("nth"), label.alias("label")).where(F.col("nth") <= examples)
    shown = first.groupBy("ccn").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "label"))), lambda x: x["label"]), "; ").alias("shown"))
    one = one.join(named, "ccn", "left").join(shown, "ccn", "left")
    scope = F.concat_ws(", ", F.concat(F.col("coverage") - F.col("items-without-prices"), F.lit(" priced")), F.concat(F.coalesce("named", F.lit(0)), F.lit(" payers")))
    rules = [
        ("info", "coverage", scope), ("error", "items-without-prices", F.col("shown")), ("warning", "gross-charge-missing", None), ("warning", "discounted-cash-missing", None),
        ("warning", "payer-rates-missing", None), ("warning", "methodology-missing", None),
    ]
    cells = [F.struct(F.lit(s).alias("severity"), F.lit(r).alias("rule"), (F.lit(None) if d is None else d).cast("string").alias("detail"), F.col(r).cast("long").alias("n")) for s, r, d in rules]
    rows = one.select("ccn", F.explode(F.array(*cells)).alias("f")).select("ccn", "f.*")
    groups = items.groupBy("ccn", "code", "code_type", "setting", F.substring("description", 1, 60)).count().where("count > 1").groupBy("ccn").agg(F.count("*").alias("n"))
    kind = F.upper(F.coalesce("code_type", F.lit("")))
    unknown = items.where(~kind.isin(KNOWN_TYPES)).groupBy("ccn", kind.alias("detail")).agg(F.count("*").alias("n"))
    most = unknown.withColumn("nth", F.row_number().over(Window.partitionBy("ccn").orderBy(F.desc("n"), "detail"))).where(F.col("nth") <= kinds)
    warned = lambda df, rule, detail: df.select("ccn", F.lit("warning").alias("severity"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"), "n")
    more = [warned(groups, "duplicate-items", F.lit(None)), warned(most, "code-type-unrecognized", F.col("detail"))]
    return reduce(DataFrame.unionByName, more, rows).where("n > 0")


def header_findings(headers: DataFrame) -> DataFrame:
    """(submission_id, rule) about a JSON file's header: version, name, address, license, date."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    day = F.try_to_date(F.substring(F.col("last_updated_on"), 1, 10))
    tests = {
        "version-missing": blank("version"), "version-not-current": ~blank("version") & (F.trim("version") != VERSION), "hospital-name-missing": blank("hospital_name"),
        "hospital-address-missing": blank("city") | blank("state"), "license-missing": blank("license"), "last-updated-missing": blank("last_updated_on"),
        "last-updated-invalid": ~blank("last_updated_on") & day.isNull(), "last-updated-future": day > F.current_date(),
    }
    found = F.filter(F.array(*[F.when(t, F.lit(r)) for r, t in tests.items()]), lambda r: r.isNotNull())
    return headers.select("submission_id", F.explode(found).alias("rule"))


def submission_findings(files: DataFrame, items: DataFrame, order: str = "seq") -> DataFrame:
    """All findings about submitted files: (ccn, severity, rule, detail, n).

    ``files`` has one row for each file: ccn, format, the header's fields, and source_count, the entries that the source
    says it holds (null: it says nothing). A header is judged only in a JSON file. A file without items has that as its
    finding in place of those on items."""
    parsed = items.groupBy("ccn").agg(F.count("*").alias("parsed"))
    about = files.join(parsed, "ccn", "left").withColumn("parsed", F.coalesce("parsed", F.lit(0)))
    as_rows = lambda df, rule, detail, n: df.select("ccn", F.lit("error").alias("severity"), rule.alias("rule"), detail.cast("string").alias("detail"), n.cast("long").alias("n"))
    none = F.lit(None)
    heads = header_findings(files.where("format = 'json'").withColumn("submission_id", F.col("ccn"))).withColumnRenamed("submission_id", "ccn")
    return (
        as_rows(heads, F.col("rule"), none, none)
        .unionByName(as_rows(about.where("source_count <> parsed"), F.lit("completeness-mismatch"), F.col("source_count"), F.col("parsed")))
        .unionByName(as_rows(about.where("parsed = 0"), F.lit("no-items"), none, none))
        .unionByName(file_findings(items.join(files.select("ccn"), "ccn", "left_semi"), order))
    )


def identity_verdicts(submissions: DataFrame, registry: DataFrame, seed_names: DataFrame | None = None) -> DataFrame:
    """(submission_id, verdict): VERIFIED, MISMATCH or UNVERIFIABLE for the facility that a file claims.

    Submissions have submission_id, ccn_claimed, hospital_name, state, city, license, and may have meta_cells, the cells of
    a delimited file's preamble, which count where the file names no hospital. The name has to agree with the registry's
    or with one of ``seed_names`` (ccn, name; legal and common names, any number for a facility), and one more sign with
    it; a contradicting state, or another name, is a mismatch. Nulls and empty texts are no sign. One row for each id."""
    cells = F.array_join("meta_cells", " ") if "meta_cells" in submissions.columns else F.lit(None).cast("string")
    given = submissions.select("submission_id", "ccn_claimed", "hospital_name", "state", "city", "license", cells.alias("cells"))
    known = registry.select(F.col("ccn").alias("ccn_claimed"), F.col("name").alias("r_name"), F.col("state").alias("r_state"), F.col("city").alias("r_city"))
    names = known.select("*", F.col("r_name").alias("candidate"))
    if seed_names is not None:
        names = names.unionByName(known.join(seed_names.select(F.col("ccn").alias("ccn_claimed"), F.col("name").alias("candidate")), "ccn_claimed"))
    up = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit(""))))

    def agrees(c: str) -> Column:
        a, b = X.name_signature(F.col(c)), X.name_signature(F.col("candidate"))
        return F.coalesce((F.size(a) >= 2) & (F.size(b) >= 2) & (F.size(F.array_intersect(a, b)) == F.least(F.size(a), F.size(b))), F.lit(False))

    keys = [*given.columns, "r_name", "r_state", "r_city"]
    one = given.join(names, "ccn_claimed", "left").groupBy(*keys).agg(F.bool_or(agrees("hospital_name")).alias("named"), F.bool_or(agrees("cells")).alias("in_cells"))
    nameless = up("hospital_name") == ""
    sign = ((up("state") != "") & (up("state") == up("r_state"))) | ((up("city") != "") & (up("city") == up("r_city"))) | (up("license") != "")
    cases = [
        (F.col("r_name").isNull() | (nameless & ~F.col("in_cells")), "UNVERIFIABLE"), (~nameless & ~F.col("named"), "MISMATCH"),
        ((up("state") != "") & (up("r_state") != "") & (up("state") != up("r_state")), "MISMATCH"), (sign, "VERIFIED"),
    ]
    return one.select("submission_id", X.choose(cases, "UNVERIFIABLE").alias("verdict"))


def misassigned(submissions: DataFrame, registry: DataFrame) -> DataFrame:
    """Submissions whose name is that of another facility than the one claimed."""
    pairs = matching.consistent_names(submissions.select(F.col("submission_id").alias("id"), F.col("hospital_name").alias("name")), registry.select(F.col("ccn").alias("id"), "name"))
    joined = submissions.join(pairs, F.col("submission_id") == F.col("l_id"))
    other = joined.groupBy("submission_id", "ccn_claimed").agg(F.bool_or(F.col("r_id") == F.col("ccn_claimed")).alias("own"), F.min("r_id").alias("named"))
    return other.where("NOT own").select("submission_id", "ccn_claimed", "named")


def completeness(source_counts: DataFrame, items: DataFrame) -> DataFrame:
    """(ccn, source_count, parsed, ok) for each file."""
    df = source_counts.join(items.groupBy("ccn").agg(F.count("*").alias("parsed")), "ccn", "left").withColumn("parsed", F.coalesce("parsed", F.lit(0)))
    return df.select("ccn", "source_count", "parsed", (F.col("source_count") == F.col("parsed")).alias("ok"))


def listing_refusals(submissions: DataFrame) -> DataFrame:
    """The first rule that refuses a submission; ``listed`` if none does. Rules in order; a partial pass lists nothing."""
    rules = [
        (F.col("quarantined"), "quarantined"), (~F.col("opted_in"), "not opted in"), (~F.col("domain_verified"), "awaiting verification"), (F.col("verdict") != "VERIFIED", "identity"),
        (F.col("source_count").isNotNull() & (F.col("source_count") != F.col("parsed")), "completeness"), (F.col("priced") == 0, "no prices"), (F.col("already_listed"), "already listed"),
        (F.col("n_domains") == 0, "no domain on file"), (~F.col("domain_bound"), "other domain"),
    ]
    return submissions.select("submission_id", X.choose([(F.coalesce(t, F.lit(True)), r) for t, r in rules], "listed").alias("status"))


def answered_gate(probes: DataFrame, least_percent: int = 50) -> DataFrame:
    """Fewer than half of the probes answered: the network failed, not the sources."""
    one = probes.agg(F.count("*").alias("n"), F.count_if(F.col("http_status") > 0).alias("answered"))
    return checks(one, "probes", {"answered": (100 * F.col("answered") >= least_percent * F.col("n"), F.col("answered"), F.col("n"))})


def claim_audit(claims: DataFrame, facts: DataFrame) -> DataFrame:
    """Published figures (metric, claimed) against recomputed ones (metric, value); without a figure to compare, skipped."""
    df = claims.join(facts, "metric", "left")
    ok = F.col("value").isNull() | (F.col("claimed") == F.col("value"))
    return df.select(F.lit("claim").alias("check_id"), F.col("metric").alias("subject"), ok.alias("ok"), F.col("claimed").cast("string").alias("observed"), F.coalesce(F.col("value").cast("string"), F.lit("skipped")).alias("expected"))


def failure_rate(results: DataFrame, most_percent: int = 30) -> DataFrame:
    one = results.agg(F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return checks(one, "ingest", {"failures": (100 * F.col("failed") <= most_percent * F.col("n"), F.col("failed"), F.col("n"))})


def freshness(stamps: DataFrame, now: Column, most_days: int = 400) -> DataFrame:
    """Timestamps (subject, at) are not in the future and not older than ``most_days``."""
    age = F.date_diff(F.to_date(now), F.to_date("at"))
    return stamps.select(F.lit("freshness").alias("check_id"), "subject", F.coalesce((F.col("at") <= now) & (age <= most_days), F.lit(False)).alias("ok"), age.cast("string").alias("observed"), F.lit(str(most_days)).alias("expected"))
