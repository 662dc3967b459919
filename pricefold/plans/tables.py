"""The domain's tables, derived by Spark from the driver's star schema, and the same tables as SQL.

Every function takes (spark, folder). ``SQL`` has a common table expression for each, for the queries' check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAYER_NAMES = ["Aetna PPO", "standard_charge|Blue Cross HMO", "Cigna", "United Healthcare Choice", "Humana Gold", "Self Pay", "Medicare Advantage", "Acme Regional Plan"]
HOSPITAL_TYPES = ["Acute Care Hospitals", "Critical Access Hospitals", "Rural Emergency Hospital", "Acute Care - Veterans Administration", "Psychiatric"]
REQUIRED_TYPES = HOSPITAL_TYPES[:4]
EPOCH = "1970-01-01"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def padded(c: Column, n: int = 6) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def pick(values: list[str], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each facility."""
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    df = read(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    kind = pick(HOSPITAL_TYPES, F.col("s_suppkey") % 5)
    return df.select(padded(F.col("s_suppkey")).alias("ccn"), F.col("s_name").alias("name"), F.col("r_name").alias("state"), F.col("n_name").alias("city"), kind.alias("hospital_type"), kind.isin(REQUIRED_TYPES).alias("required"))


def payer_places() -> Column:
    """The places of the payers that an item has, over lineitem's columns."""
    return F.slice(F.array(F.lit(0), F.lit(1), F.lit(2)), 1, F.greatest(F.coalesce(F.col("l_linenumber") % 4, F.lit(0)), F.lit(0)).cast("int"))


def payer_at(k: Column) -> Column:
    """The payer at a place and its rate, over lineitem's columns."""
    rate = F.when((F.col("l_orderkey") + k) % 11 != 0, F.col("l_extendedprice") * (F.lit(0.25) * (k + 1)))
    return F.struct(pick(PAYER_NAMES, (F.col("l_orderkey") + k) % 8).alias("payer"), rate.alias("rate_dollar"))


def items(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """Parsed price items, payer rates as an array; ``more`` are columns of lineitem to keep."""
    n, p, price = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_extendedprice")
    code = (
        F.when(p % 10 == 0, "").when(p % 10 == 1, F.concat(F.lit("J"), F.lpad((p % 89).cast("string"), 4, "0")))
        .when(p % 10 == 2, F.lpad((p % 500).cast("string"), 3, "0")).when(p % 10 == 3, F.concat(F.lit("X"), (p % 50).cast("string")))
        .otherwise(F.lpad((p % 97).cast("string"), 5, "0"))
    )
    gross = F.when((n % 5 != 0) & ~((n == 4) & (p % 3 == 0)), price)
    # one function over the payers that an item has; three structs written out would make the plan's methods too long to be compiled
    payers = F.transform(payer_places(), payer_at)
    return read(spark, folder, "lineitem").select(
        padded(F.col("l_suppkey")).alias("ccn"), (F.col("l_orderkey") * 10 + n).alias("seq"), code.alias("code"),
        F.when(p % 10 == 0, "").when(p % 10 == 1, "HCPCS").when(p % 10 == 2, "DRG").when(p % 10 == 3, "LOCAL").otherwise("CPT").alias("code_type"), F.concat(F.lit("Item "), p.cast("string")).alias("description"),
        F.col("l_linestatus").alias("setting"), F.col("l_returnflag").alias("billing_class"), gross.alias("gross"),
        F.when(n % 4 != 0, price * (1 - F.col("l_discount"))).alias("cash"), F.when(n % 2 == 0, price * 0.5).alias("min_rate"), F.when(n % 3 != 0, price * 1.5).alias("max_rate"),
        (n == 7).alias("history"), F.when(n == 7, F.to_date("l_shipdate")).alias("effective_date"), payers.alias("payers"), *more,
    )


def probes(spark: SparkSession, folder: str) -> DataFrame:
    """The log of URL probes: one row for each event."""
    kind = F.col("event_type")
    status = F.when(F.col("event_id") % 13 == 0, 404).when(F.col("event_id") % 7 == 0, 304).when(F.col("event_id") % 11 == 0, -1).when(F.col("event_id") % 17 == 0, 503).otherwise(200)
    return read(spark, folder, "events").select(
        padded(F.col("user_id") % 97).alias("ccn"), F.concat(F.lit("https://www.f"), (F.col("user_id") % 97).cast("string"), F.lit(".example.org/"), kind, F.lit("_standardcharges.csv")).alias("mrf_url"),
        F.col("ts").alias("probed_at"), F.col("event_id"), status.alias("http_status"), status.isin(200, 304).alias("alive"),
        F.when(status == 200, F.floor(F.col("value") / 40).cast("string")).alias("sha256"), F.when(F.col("event_id") % 3 == 0, "text/csv").when(F.col("event_id") % 3 == 1, "text/html").otherwise("application/json").alias("content_type"),
    )


def seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Known (facility, URL) pairs: the probed ones of even facilities, one without any probe for each third facility."""
    known = probes(spark, folder).where("cast(ccn AS int) % 2 = 0").select("ccn", "mrf_url").distinct()
    other = registry(spark, folder).where("cast(ccn AS int) % 3 = 0").select("ccn", F.concat(F.lit("https://old.example.org/"), "ccn", F.lit(".json")).alias("mrf_url"))
    return known.unionByName(other)


def rediscovered(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates found by link search: one row for each (facility, URL) of odd facilities."""
    found = probes(spark, folder).where("cast(ccn AS int) % 2 = 1 OR cast(ccn AS int) % 5 = 0").groupBy("ccn", F.col("mrf_url").alias("candidate_url"))
    return found.agg((F.count("*") % 9).cast("int").alias("score"), F.max("probed_at").alias("discovered_at"), F.max_by("http_status", "event_id").alias("head_status"), F.max_by("content_type", "event_id").alias("head_content_type"), F.max_by("alive", "event_id").alias("alive"))


def enforcement(spark: SparkSession, folder: str) -> DataFrame:
    """Regulator's actions: one row for each order."""
    df = read(spark, folder, "orders")
    return df.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("case_id"), padded(F.col("o_custkey") % 103).alias("ccn"), F.col("o_orderpriority").alias("action"), F.to_date("o_orderdate").alias("date_of_action"), F.col("o_orderkey").alias("row_id"))


_SQL = {
    "registry": """registry AS (SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS ccn, s_name AS name, r_name AS state, n_name AS city,
  CASE s_suppkey % 5 WHEN 0 THEN 'Acute Care Hospitals' WHEN 1 THEN 'Critical Access Hospitals' WHEN 2 THEN 'Rural Emergency Hospital' WHEN 3 THEN 'Acute Care - Veterans Administration' ELSE 'Psychiatric' END AS hospital_type,
  s_suppkey % 5 < 4 AS required FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "items": """items AS (SELECT lpad(l_suppkey::VARCHAR, 6, '0') AS ccn, l_orderkey * 10 + l_linenumber AS seq,
  CASE l_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'J' || lpad((l_partkey % 89)::VARCHAR, 4, '0') WHEN 2 THEN lpad((l_partkey % 500)::VARCHAR, 3, '0') WHEN 3 THEN 'X' || (l_partkey % 50)::VARCHAR ELSE lpad((l_partkey % 97)::VARCHAR, 5, '0') END AS code,
  CASE l_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'HCPCS' WHEN 2 THEN 'DRG' WHEN 3 THEN 'LOCAL' ELSE 'CPT' END AS code_type, 'Item ' || l_partkey::VARCHAR AS description, l_linestatus AS setting, l_returnflag AS billing_class,
  CASE WHEN l_linenumber % 5 <> 0 AND NOT (l_linenumber = 4 AND l_partkey % 3 = 0) THEN l_extendedprice END AS gross, CASE WHEN l_linenumber % 4 <> 0 THEN l_extendedprice * (1 - l_discount) END AS cash,
  CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice * 0.5::DOUBLE END AS min_rate, CASE WHEN l_linenumber % 3 <> 0 THEN l_extendedprice * 1.5::DOUBLE END AS max_rate, l_linenumber = 7 AS history, CASE WHEN l_linenumber = 7 THEN l_shipdate::DATE END AS effective_date,
  list_transform(range(0, (l_linenumber % 4)::BIGINT), lambda k: {'payer': ['Aetna PPO', 'standard_charge|Blue Cross HMO', 'Cigna', 'United Healthcare Choice', 'Humana Gold', 'Self Pay', 'Medicare Advantage', 'Acme Regional Plan'][(l_orderkey + k) % 8 + 1],
    'rate_dollar': CASE WHEN (l_orderkey + k) % 11 <> 0 THEN l_extendedprice * (0.25::DOUBLE * (k + 1)) END}) AS payers FROM lineitem)""",
    "usable": """usable AS (SELECT * EXCLUDE (code, code_type), CASE WHEN code = '' THEN description ELSE code END AS code, CASE WHEN code_type IN ('', 'LOCAL') THEN 'CDM' ELSE code_type END AS type, len(payers) AS n_payers
  FROM items WHERE gross IS NOT NULL OR cash IS NOT NULL OR len(payers) > 0)""",
    "slim": """ranked AS (SELECT *, row_number() OVER (PARTITION BY ccn, code, billing_class, setting ORDER BY n_payers DESC, seq, description DESC, coalesce(gross, -1) DESC, coalesce(cash, -1) DESC, coalesce(min_rate, -1) DESC, coalesce(max_rate, -1) DESC, history DESC) AS rn FROM usable),
clash AS (SELECT ccn, code, billing_class, setting FROM usable GROUP BY ALL HAVING bool_or(history) AND (coalesce(min(gross) <> max(gross), false) OR count(gross) BETWEEN 1 AND count(*) - 1)),
slim AS (SELECT ccn, code, type, substr(description, 1, 100) AS "desc", gross, cash, min_rate AS "min", max_rate AS "max", n_payers AS pc,
  list_transform(list_reverse(list_filter(payers, lambda x: x.rate_dollar > 0)), lambda x: {'p': substr(x.payer, 1, 40), 'r': x.rate_dollar}) AS top, billing_class AS bc, setting AS s
  FROM ranked ANTI JOIN clash USING (ccn, code, billing_class, setting) WHERE rn = 1)""",
    "stats": """cells AS (SELECT ccn, unnest(top) AS x FROM slim),
raw_stats AS (SELECT ccn, x.p AS raw_payer, count(*) AS n_items, count_if(x.r > 0) AS n_rates, min(x.r) AS lowest, max(x.r) AS highest, percentile_disc(0.5) WITHIN GROUP (ORDER BY x.r DESC) AS median FROM cells GROUP BY ALL),
stats AS (SELECT *, CASE WHEN raw_payer ILIKE '%self pay%' THEN 'cash' WHEN raw_payer ILIKE '%medicare advantage%' THEN 'medicare-advantage' WHEN raw_payer ILIKE '%blue cross%' THEN 'bcbs' WHEN raw_payer ILIKE '%aetna%' THEN 'aetna'
    WHEN raw_payer ILIKE '%united health%' THEN 'uhc' WHEN raw_payer ILIKE '%cigna%' THEN 'cigna' WHEN raw_payer ILIKE '%humana%' THEN 'humana' ELSE 'acme-regional' END AS slug FROM raw_stats)""",
    "scores": """counted AS (SELECT ccn, count(*) AS item_count, count(gross) AS n_gross, count(cash) AS n_cash, count_if(pc > 0) AS n_payer, count_if("min" IS NOT NULL AND "max" IS NOT NULL) AS n_minmax FROM slim GROUP BY ccn),
pointed AS (SELECT *, (25 + 10 + CASE WHEN 100 * n_gross >= 80 * item_count THEN 15 ELSE 0 END + CASE WHEN 100 * n_cash >= 50 * item_count THEN 15 ELSE 0 END + CASE WHEN 100 * n_payer >= 50 * item_count THEN 20 ELSE 0 END + CASE WHEN 100 * n_minmax >= 50 * item_count THEN 15 ELSE 0 END)::INT AS score FROM counted),
scores AS (SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade FROM pointed)""",
    "entries": """entries AS (SELECT code, ccn, "desc", gross, cash, "min", "max", pc, list_max(list_transform(top, lambda x: x.r)) AS payer_max, bc, s, top FROM slim WHERE type IN ('CPT', 'HCPCS'))""",
    "flagged": """medians AS (SELECT code, percentile_disc(0.5) WITHIN GROUP (ORDER BY cash DESC) AS cash_median FROM entries GROUP BY code),
flagged AS (SELECT e.*, cash_median, CASE WHEN cash IS NULL THEN 'missing' WHEN cash < greatest(50.0::DOUBLE, 0.05::DOUBLE * cash_median) THEN 'low' WHEN cash > 25.0::DOUBLE * cash_median THEN 'high' ELSE 'normal' END AS quality FROM entries e JOIN medians USING (code))""",
    "idx": """idx AS (SELECT ccn, count(*) AS n, count_if(type IN ('CPT', 'HCPCS')) AS cpt_indexed FROM slim GROUP BY ccn)""",
    "probes": """probes AS (SELECT lpad((user_id % 97)::VARCHAR, 6, '0') AS ccn, 'https://www.f' || (user_id % 97)::VARCHAR || '.example.org/' || event_type || '_standardcharges.csv' AS mrf_url, ts AS probed_at, event_id,
  CASE WHEN event_id % 13 = 0 THEN 404 WHEN event_id % 7 = 0 THEN 304 WHEN event_id % 11 = 0 THEN -1 WHEN event_id % 17 = 0 THEN 503 ELSE 200 END AS http_status,
  event_id % 13 <> 0 AND (event_id % 7 = 0 OR event_id % 11 <> 0 AND event_id % 17 <> 0) AS alive,
  CASE WHEN event_id % 13 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 17 <> 0 THEN floor(value / 40)::BIGINT::VARCHAR END AS sha256,
  CASE event_id % 3 WHEN 0 THEN 'text/csv' WHEN 1 THEN 'text/html' ELSE 'application/json' END AS content_type FROM events)""",
    "seeds": """seeds AS (SELECT DISTINCT ccn, mrf_url FROM probes WHERE ccn::INT % 2 = 0 UNION ALL SELECT ccn, 'https://old.example.org/' || ccn || '.json' FROM registry WHERE ccn::INT % 3 = 0)""",
    "rediscovered": """rediscovered AS (SELECT ccn, mrf_url AS candidate_url, (count(*) % 9)::INT AS score, max(probed_at) AS discovered_at, arg_max(http_status, event_id) AS head_status, arg_max(content_type, event_id) AS head_content_type,
  arg_max(alive, event_id) AS alive FROM probes WHERE ccn::INT % 2 = 1 OR ccn::INT % 5 = 0 GROUP BY ALL)""",
    "enforcement": """enforcement AS (SELECT 'C' || o_custkey::VARCHAR AS case_id, lpad((o_custkey % 103)::VARCHAR, 6, '0') AS ccn, o_orderpriority AS action, o_orderdate::DATE AS date_of_action, o_orderkey AS row_id FROM orders)""",
}
_SQL |= {
    "latest": """latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ccn, mrf_url ORDER BY probed_at DESC, event_id DESC) AS rn FROM probes) WHERE rn = 1)""",
    "best": """both_sources AS (SELECT s.ccn, s.mrf_url AS url, 1 AS score, probed_at AS "at", 'seed' AS source FROM seeds s JOIN probes p ON s.ccn = p.ccn AND s.mrf_url = p.mrf_url WHERE alive
  UNION ALL SELECT ccn, candidate_url, score, discovered_at, 'rediscovered' FROM rediscovered WHERE alive),
best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ccn ORDER BY score DESC, "at" DESC, source DESC, url DESC) AS rn FROM both_sources) WHERE rn = 1)""",
    "live": """live AS (SELECT ccn FROM seeds SEMI JOIN (SELECT * FROM probes WHERE alive) USING (ccn, mrf_url) UNION SELECT ccn FROM rediscovered WHERE alive)""",
    "facts": """facts AS (SELECT r.*, b.ccn IS NOT NULL AS has_live, coalesce(cases, 0) AS cases FROM registry r LEFT JOIN best b USING (ccn) LEFT JOIN (SELECT ccn, count(DISTINCT case_id) AS cases FROM enforcement GROUP BY ccn) USING (ccn))""",
}
_NEEDS = {
    "usable": ["items"], "slim": ["items", "usable"], "stats": ["items", "usable", "slim"], "scores": ["items", "usable", "slim"], "entries": ["items", "usable", "slim"], "flagged": ["items", "usable", "slim", "entries"], "idx": ["items", "usable", "slim"],
    "latest": ["probes"], "best": ["registry", "probes", "seeds", "rediscovered"], "live": ["registry", "probes", "seeds", "rediscovered"], "facts": ["registry", "probes", "seeds", "rediscovered", "best", "enforcement"],
    "seeds": ["registry", "probes"], "rediscovered": ["probes"],
}


def whole(text: str) -> str:
    """``count_if(x)`` as a 64-bit count."""
    while (at := text.find("count_if(")) >= 0:
        depth, end = 1, at + 9
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        text = f"{text[:at]}count(CASE WHEN {text[at + 9 : end - 1]} THEN 1 END){text[end:]}"
    return text


def sql(body: str, *names: str) -> str:
    """``WITH`` the named tables (and what they need) before ``body``, which may itself begin with more: ``WITH x AS ...``."""
    wanted: list[str] = []
    for n in names:
        wanted += [x for x in [*_NEEDS.get(n, []), n] if x not in wanted]
    head = ",\n".join(_SQL[n] for n in wanted)
    body = body.strip()
    return whole(f"WITH {head}\n" + (", " + body[5:] if body[:5].upper() == "WITH " else body))
