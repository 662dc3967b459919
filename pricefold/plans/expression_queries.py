"""Registered queries of expressions that other queries only pass through: each over a whole table, in all their cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.functions import expressions as X
from pricefold.functions.medians import true_median, upper_median
from pricefold.operators import registry, search
from pricefold.plans import tables as T
from pricefold.plans.queries import facts, query, slim


def case(i, texts: list[str | None]):
    """The text of a case, by number."""
    return F.element_at(F.array(*[F.lit(t).cast("string") for t in texts]), (i % len(texts) + 1).cast("int"))


def listed(texts: list[str | None]) -> str:
    """The same list in SQL."""
    return "[" + ", ".join("NULL" if t is None else "'" + t.replace("'", "''") + "'" for t in texts) + "]"


def counted(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey % 7 AS form, count(*) AS n, count(m) AS n_money, sum(m) AS money FROM (SELECT o_orderkey,
  CASE o_orderkey % 7 WHEN 0 THEN o_orderkey::DOUBLE WHEN 1 THEN o_orderkey + 0.5::DOUBLE WHEN 4 THEN o_orderkey * 100::DOUBLE WHEN 6 THEN -o_orderkey::DOUBLE END AS m FROM orders) GROUP BY o_orderkey % 7""")
def f8_money(s, d):
    """Prices with signs, separators, blanks and exponents; words, dashes and mixtures are none."""
    k = F.col("o_orderkey")
    text = X.choose([
        (k % 7 == 0, F.concat(F.lit("$"), F.floor(k / 1000).cast("string"), F.lit(","), F.lpad((k % 1000).cast("string"), 3, "0"))), (k % 7 == 1, F.concat(F.lit("  "), k.cast("string"), F.lit(".5 "))),
        (k % 7 == 2, F.lit("N/A")), (k % 7 == 3, F.lit(" - ")), (k % 7 == 4, F.concat(k.cast("string"), F.lit("e2"))), (k % 7 == 5, F.concat(F.lit("about "), k.cast("string"))),
    ], F.concat(F.lit("-$"), k.cast("string")))
    df = T.read(s, d, "orders").select((k % 7).alias("form"), X.to_money(text).alias("m"))
    return df.groupBy("form").agg(F.count("*").alias("n"), F.count("m").alias("n_money"), F.sum("m").alias("money"))


_LABELS = ["CPT", "hcpcs", " ms_drg", "MSDRG", "rc", "Rev Code", "icd 10", "Charge Code", "billing_code", "Code", "CPT_HCPCS", "odd x", None]
_CANON = ["CPT", "HCPCS", "MS-DRG", "MS-DRG", "REV", "REV", "ICD-10", "CDM", "BILLING-CODE", "", "CPT-HCPCS", "ODDX", ""]


@query(f"SELECT {listed(_CANON)}[p_partkey % 13 + 1] AS code_type, count(*) AS n FROM part GROUP BY 1")
def f10_type_labels(s, d):
    return counted(T.read(s, d, "part").select(X.canon_code_type(case(F.col("p_partkey"), _LABELS)).alias("code_type")))


@query("""SELECT CASE f WHEN 0 THEN k5 WHEN 1 THEN k3 WHEN 2 THEN 'J' || k4 WHEN 3 THEN 'J' || k4 WHEN 4 THEN k4 ELSE 'X ' || k3 END AS code, ['CPT', 'MS-DRG', 'HCPCS', 'HCPCS', 'REV', 'CHARGE-CODE'][f + 1] AS code_type, count(*) AS n
FROM (SELECT p_partkey % 6 AS f, lpad((p_partkey % 97)::VARCHAR, 5, '0') AS k5, lpad((p_partkey % 97)::VARCHAR, 4, '0') AS k4, lpad((p_partkey % 97)::VARCHAR, 3, '0') AS k3 FROM part) GROUP BY ALL""")
def f11_prefixed_codes(s, d):
    """Prefixes of codes in several spellings, blanks that don't break, and a label with an underscore, which stays as it is."""
    digits = lambda n: F.lpad((F.col("p_partkey") % 97).cast("string"), n, "0")
    form = F.col("p_partkey") % 6
    code = X.choose([
        (form == 0, F.concat(F.lit("CPT: "), digits(5))), (form == 1, F.concat(F.lit("ms drg-"), digits(3))), (form == 2, F.concat(F.lit(" J"), digits(4))),
        (form == 3, F.concat(F.lit("\u00a0HCPCS\u00a0J"), digits(4))), (form == 4, F.concat(F.lit("REV#"), digits(4))),
    ], F.concat(F.lit(" X "), digits(3)))
    return counted(T.read(s, d, "part").select(X.normalize_code(code, F.when(form == 5, "charge_code")).alias("x")).select("x.*"))


@query("""SELECT CASE WHEN code = '' AND priced THEN description ELSE code END AS code, CASE WHEN code = '' OR code_type = 'LOCAL' AND priced THEN 'CDM' ELSE code_type END AS type, count(*) AS n
FROM (SELECT *, gross IS NOT NULL OR cash IS NOT NULL OR len(payers) > 0 AS priced FROM items) GROUP BY ALL""", "items")
def f12_display_codes(s, d):
    priced = X.has_price(F.col("gross"), F.col("cash"), F.size("payers"))
    return counted(T.items(s, d).select(X.display_code_type(F.col("code"), F.col("code_type"), F.col("description"), priced).alias("x")).select("x.*"))


_NAMES = ["Crédit  Santé_No", "--Ünion (of) ", "A_b - C", "!!!", None]
_SLUGS = ["credit-sante-no", "union-of", "a-b-c", "unknown", "unknown"]


@query(f"SELECT {listed(_SLUGS)}[p_partkey % 5 + 1] AS slug, count(*) AS n FROM part GROUP BY 1")
def f14_slugs(s, d):
    return counted(T.read(s, d, "part").select(X.slugify(case(F.col("p_partkey"), _NAMES)).alias("slug")))


_URLS = ["https://a.org/x.CSV?y", "https://drive.google.com/uc?id=3&export=download", "https://x.sharepoint.com/s/a", "https://urldefense.com/v3/__https://a.org/b.json__;x", "https://a.org/urldefense.com/page", "https://a.org/doc.pdf", "https://cms.gov/hospital-price-transparency", "https://a.org/standardcharges"]
_KINDS = ["text/csv", "application/octet-stream", "text/html", "application/json", "text/html", "application/pdf", "text/html", "text/html"]


@query("""SELECT event_id % 8 AS form, count(*) AS n, event_id % 8 IN (0, 1, 3, 7) AS direct, event_id % 8 IN (0, 3) AS suffix, event_id % 8 = 2 AS wrapper, event_id % 8 = 3 AS protected, event_id % 8 IN (5, 6, 7) AS rejected, event_id % 8 IN (0, 1, 3) AS file_type
FROM events GROUP BY event_id % 8""")
def f18_url_flags(s, d):
    """Every flag of a candidate, for addresses that one flag alone tells apart."""
    e = F.col("event_id")
    url, kind = case(e, _URLS), case(e, _KINDS)
    flags = {"direct": X.is_direct_file(url), "suffix": X.has_file_suffix(url), "wrapper": X.is_html_wrapper(url), "protected": X.is_protected_wrapper(url), "rejected": X.is_rejected(url, kind), "file_type": X.is_file_type(kind)}
    return counted(T.read(s, d, "events").select((e % 8).alias("form"), *[c.alias(k) for k, c in flags.items()]))


_TOKENS = "string_split(trim(regexp_replace(lower('The ' || name || ' of ' || city || ' Hospital, Inc.'), '[^a-z0-9]+', ' ', 'g')), ' ')"


@query(f"""SELECT ccn, array_to_string(list_filter({_TOKENS}, lambda t: t NOT IN ('the', 'of', 'inc')), ' ') AS norm,
  array_to_string(list_sort(list_distinct(list_filter({_TOKENS}, lambda t: length(t) >= 3 AND t NOT IN ('the', 'of', 'inc', 'hospital')))), '|') AS signature FROM registry""", "registry")
def f19_names(s, d):
    name = F.concat(F.lit("The "), "name", F.lit(" of "), "city", F.lit(" Hospital, Inc."))
    return T.registry(s, d).select("ccn", X.name_norm(name).alias("norm"), F.array_join(F.array_sort(X.name_signature(name)), "|").alias("signature"))


@query("SELECT CASE WHEN k >= 90 THEN 'A' WHEN k >= 80 THEN 'B' WHEN k >= 70 THEN 'C' WHEN k >= 60 THEN 'D' ELSE 'F' END AS grade, k, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 101 > 0 THEN o_orderkey % 101 END AS k FROM orders) GROUP BY ALL")
def f21_grades(s, d):
    k = F.col("o_orderkey") % 101
    return counted(T.read(s, d, "orders").select(F.when(k > 0, k).alias("k")).withColumn("grade", X.grade_for(F.col("k"))))


_ERRORS = ["no_live_mrf", "seed:-:probe_html:x", "rediscovered:-:probe_reject:y", "timeout:60", "x:timeout:5", "late no_live_mrf", "other:-:probe_html:x", "0.4s", None]
_REASONS = ["no_live_mrf_after_rediscovery", "mrf_url_returns_html_wrapper", "mrf_url_returns_html_wrapper", "mrf_fetch_timeout", "mrf_fetch_timeout", "hard_failure", "mrf_url_returns_html_wrapper", "hard_failure", "hard_failure"]


@query(f"SELECT event_id % 9 < 5 AS hard, {listed(_REASONS)}[event_id % 9 + 1] AS reason, count(*) AS n FROM events GROUP BY 1, 2")
def f23_failure_reasons(s, d):
    error = case(F.col("event_id"), _ERRORS)
    return counted(T.read(s, d, "events").select(X.is_hard_failure(error).alias("hard"), X.failure_reason(error).alias("reason")))


_FOUND = "(contains(lower(name), '1') OR contains(lower(city), '1') OR contains(ccn, '1'))"


@query(f"""SELECT 'compliant' AS status, ccn FROM facts WHERE required AND has_live AND {_FOUND} UNION ALL SELECT 'missing', ccn FROM facts WHERE required AND NOT has_live AND {_FOUND}
UNION ALL SELECT 'enforcement', ccn FROM facts WHERE cases > 0 AND {_FOUND} UNION ALL SELECT 'missing-enforcement', ccn FROM facts WHERE required AND NOT has_live AND cases > 0 AND {_FOUND}""", "facts")
def p3_directory_filters(s, d):
    """Each status of the directory, with a text."""
    df = facts(s, d)
    parts = [search.directory(df, "1", status=k).select(F.lit(k).alias("status"), "ccn") for k in ("compliant", "missing", "enforcement", "missing-enforcement")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("SELECT s.ccn, s.mrf_url, http_status, event_id FROM seeds s LEFT JOIN latest l ON s.ccn = l.ccn AND s.mrf_url = l.mrf_url", "registry", "seeds", "latest")
def j2_latest_by_seed(s, d):
    """Every seed with its last probe, if it has any."""
    return T.seeds(s, d).join(registry.latest_probes(T.probes(s, d)), ["ccn", "mrf_url"], "left").select("ccn", "mrf_url", "http_status", "event_id")


@query("SELECT code, percentile_disc(0.5) WITHIN GROUP (ORDER BY gross DESC) AS upper, median(gross) AS middle FROM slim GROUP BY code", "slim")
def w13_medians(s, d):
    """The upper and the true median of each code's charges."""
    return slim(s, d).groupBy("code").agg(upper_median("gross").alias("upper"), true_median("gross").alias("middle"))
