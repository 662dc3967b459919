"""Registered queries of readers, column profiles and streams: data that Spark derives from the given tables is written and read again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.functions import expressions as X
from pricefold.operators import indexes, merges, quality, registry, standardize
from pricefold.plans import tables as T
from pricefold.plans.queries import SQL, index, query, slim, submissions
from pricefold.sources import files, layout, sinks, web
from pricefold.streaming import changes, stateful

# ---- readers -------------------------------------------------------------------------------------------------------


def spread(df):
    """A small table dealt over as many tasks as shuffles have: each of its rows becomes a file, and files are what takes time."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def one_each(df):
    """A writer of one file for each row. Tasks move their files into place themselves; by default the driver moves them one by one."""
    return df.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")



@query("SELECT ccn, code, gross, count(*) AS n FROM items WHERE gross IS NOT NULL AND code <> '' GROUP BY ALL", "items")
def s5_ingest_xml(s, d):
    tag = lambda name, *inner: F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))
    code = tag("code_information", tag("code", F.col("code")), tag("type", F.lit("CDM")))
    entry = tag("standard_charge_information", tag("description", F.col("description")), code, tag("standard_charges", tag("gross_charge", F.col("gross").cast("string"))))
    folder = sinks.scratch_path(s, "xml")
    docs = T.items(s, d).where("gross IS NOT NULL AND code <> ''").select("ccn", tag("hospital", tag("hospital_name", F.col("ccn")), entry).alias("doc"))
    files_ = docs.groupBy("ccn").agg(tag("root", F.array_join(F.sort_array(F.collect_list("doc")), "")).alias("value"))  # a file for each facility
    one_each(files_.select("value")).text(folder)
    return files.ingest_documents(files.read_xml(s, folder)).groupBy(F.col("hospital_name").alias("ccn"), "code", "gross").agg(F.count("*").alias("n"))


@query("SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'html' WHEN 1 THEN 'json' WHEN 2 THEN 'xml' WHEN 3 THEN 'gzip' WHEN 4 THEN 'pdf' WHEN 5 THEN 'empty' WHEN 6 THEN 'csv' WHEN 7 THEN 'xlsx' ELSE 'unknown' END AS format FROM pages")
def s6_formats(s, d):
    k = F.col("page_id") % 9
    heads = {1: F.concat(F.lit("﻿ {\"a\": \""), "url", F.lit("\"}")), 2: F.lit("<?xml version='1.0'?><a/>"), 4: F.lit("%PDF-1.7"), 5: F.lit(""), 6: F.lit("a,b,c\n1,2,3"), 7: F.lit("PK\x03\x04"), 8: F.lit("plain words")}
    content = X.choose([(k == i, F.encode(c, "UTF-8")) for i, c in heads.items()] + [(k == 3, F.unhex(F.lit("1F8B0800")))], F.encode("html", "UTF-8"))
    pages = T.read(s, d, "pages").select("page_id", content.alias("content"), F.when(k == 7, "book.xlsx").otherwise("file").alias("name"))
    return pages.select("page_id", files.sniff_format(F.col("content"), F.col("name")).alias("format"))


@query("SELECT ccn, CASE WHEN ccn::INT % 3 = 0 THEN name ELSE upper(name) END AS name FROM registry", "registry")
def s7_corpus(s, d):
    """One file for each facility: packed ones of all, plain ones of a third."""
    folder, r = sinks.scratch_path(s, "corpus"), spread(T.registry(s, d).select("ccn", "name"))
    one_each(r.where("cast(ccn AS int) % 3 = 0")).json(f"{folder}/plain")
    one_each(r.withColumn("name", F.upper("name"))).option("compression", "gzip").json(f"{folder}/packed")
    return files.read_corpus(s, f"{folder}/*", "name string")


@query("SELECT ccn, CASE WHEN ccn::INT % 4 = 0 THEN 'again ' || name ELSE name END AS name FROM registry", "registry")
def s8_load_registry(s, d):
    r = T.registry(s, d).select("ccn", "name", F.lit(1).alias("ordinal"))
    return files.load_registry(r.unionByName(r.where("cast(ccn AS int) % 4 = 0").withColumns({"name": F.concat(F.lit("again "), "name"), "ordinal": F.lit(2)})))


@query("SELECT ccn, mrf_url, min(event_id) AS event_id FROM probes WHERE ccn::INT % 5 <> 0 GROUP BY ALL", "probes")
def s9_load_seeds(s, d):
    return files.load_seeds(T.probes(s, d).select(F.when(F.expr("cast(ccn AS int) % 5 <> 0"), F.col("ccn")).otherwise(" ").alias("ccn"), "mrf_url", "event_id", F.col("event_id").alias("ordinal")))


@query("SELECT case_id, ccn, action, date_of_action, row_id::VARCHAR AS row_id FROM enforcement", "enforcement")
def s10_load_enforcement(s, d):
    """Cases written as CSV with dates in two forms."""
    folder = sinks.scratch_path(s, "enforcement")
    day = F.when(F.col("row_id") % 2 == 0, F.date_format("date_of_action", "M/d/yyyy")).otherwise(F.date_format("date_of_action", "yyyy-MM-dd"))
    T.enforcement(s, d).withColumn("date_of_action", day).write.option("header", True).csv(folder)
    return files.load_enforcement(s, folder)


@query("SELECT event_id, http_status FROM probes WHERE event_id % 6 > 1", "probes")
def s11_read_jsonl(s, d):
    """JSON lines, of which some are blank and some cut off."""
    folder = sinks.scratch_path(s, "lines")
    line = F.to_json(F.struct("event_id", "http_status"))
    k = F.col("event_id") % 6
    T.probes(s, d).select(X.choose([(k == 0, F.lit("")), (k == 1, F.expr("substring(to_json(struct(event_id)), 1, 9)"))], line).alias("value")).write.text(folder)
    return files.read_jsonl(s, folder, "event_id long, http_status int")


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderkey % 5 AS k, (o_orderdate::DATE + INTERVAL (o_orderkey % 40) YEAR)::DATE AS day FROM orders)
SELECT id, CASE WHEN k < 3 AND year(day) BETWEEN 2019 AND 2031 THEN day END AS day FROM o""")
def s12_declared_dates(s, d):
    o = T.read(s, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 5).alias("k"), F.add_months(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40 * 12).cast("int")).alias("day"))
    text = lambda f: F.date_format("day", f)
    head = X.choose([(F.col("k") == 0, F.concat(F.lit('{"last_updated_on": "'), text("yyyy-MM-dd"), F.lit('"'))), (F.col("k") == 1, F.concat(F.lit("hospital_name,Last Updated On,version\nMercy,"), text("M/d/yyyy"), F.lit(",3"))), (F.col("k") == 2, F.concat(F.lit("\n\"last_updated_on\",x\n\""), text("yyyy-MM-dd"), F.lit("\",y"))), (F.col("k") == 3, F.lit("a,b\n1,2"))], "")
    return o.select("id", files.declared_date(head).alias("day"))


@query("SELECT ccn AS hospital_name, CASE WHEN ccn::INT % 3 < 2 THEN 'Town' || chr(97 + (ccn::INT % 26)) END AS city, CASE WHEN ccn::INT % 3 < 2 THEN 'OR' END AS state, CASE WHEN ccn::INT % 3 < 2 THEN '97' || right(ccn, 3) END AS zip, ccn || '-7' AS license, 'OR' AS license_state, '3.0.0' AS version FROM registry", "registry")
def s13_headers(s, d):
    """Addresses as an object, as a text, and none."""
    k, town, zip_ = F.col("ccn").cast("int"), F.concat(F.lit("Town"), F.char(97 + F.col("ccn").cast("int") % 26)), F.concat(F.lit("97"), F.substring("ccn", -3, 3))
    address = X.choose([(k % 3 == 0, F.concat(F.lit("1 Main St, "), town, F.lit(", OR "), zip_, F.lit("-0001"))), (k % 3 == 1, F.to_json(F.struct(town.alias("city"), F.lit("OR").alias("state"), zip_.alias("zip"))))])
    docs = T.registry(s, d).select(F.col("ccn").alias("hospital_name"), address.alias("hospital_address"), F.lit(None).cast("string").alias("hospital_location"), F.struct(F.concat("ccn", F.lit("-7")).alias("license_number"), F.lit("OR").alias("state")).alias("license_information"), F.lit("3.0.0").alias("version"), F.lit(None).cast("string").alias("last_updated_on"))
    return files.extract_header(docs).drop("last_updated_on")


_LOCS = "x AS (SELECT page_id, 'https://h' || page_id::VARCHAR || '.org/' || CASE page_id % 4 WHEN 0 THEN 'about.html' WHEN 1 THEN 'f.csv' WHEN 2 THEN 'transparency/f.json' ELSE 'very_long_name_of_file.csv' END AS href, CASE page_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 5 ELSE 4 END AS score FROM pages)"


def located(s, d):
    name = X.choose([(F.col("page_id") % 4 == i, n) for i, n in enumerate(("about.html", "f.csv", "transparency/f.json", "very_long_name_of_file.csv"))])
    return T.read(s, d, "pages").select("page_id", F.concat(F.lit("https://h"), "page_id", F.lit(".org/"), name).alias("href"))


@query(f"WITH {_LOCS} SELECT page_id, href, score FROM x WHERE score >= 3")
def s15_sitemaps(s, d):
    """Each entry stands twice in its sitemap."""
    loc = F.concat(F.lit("<url><loc> "), "href", F.lit(" </loc></url>"))
    return web.harvest_sitemap(located(s, d).select("page_id", F.concat(F.lit("<urlset>"), loc, loc, F.lit("</urlset>")).alias("xml")))


@query(f"WITH {_LOCS} SELECT page_id, href, score FROM x WHERE score >= 3")
def s14_harvested_links(s, d):
    """Relative and absolute anchors of derived pages: resolved, scored, the best score of each."""
    tag = lambda href, text: F.concat(F.lit('<a class="x" href="'), href, F.lit(f'">{text}</a>'))
    short = F.regexp_extract("href", r"^https://[^/]*(/.*)$", 1)
    html = F.concat(tag(F.col("href"), ""), tag(short, "<b>here</b>"), tag(F.lit("/favicon.ico"), ""), tag(F.lit("#top"), ""))
    return web.harvest_links(located(s, d).select("page_id", F.regexp_extract("href", "^https://[^/]*", 0).alias("url"), html.alias("html")))


@query(f"WITH {_LOCS}, y AS (SELECT page_id // 100 AS page_id, href, score FROM x), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, href) AS rank FROM y) SELECT page_id, href, score, rank FROM r WHERE rank <= 10")
def w8_top_links(s, d):
    links = located(s, d).withColumn("score", X.score_link(F.col("href"), F.lit("")))
    return web.top_links(links.withColumn("page_id", F.floor(F.col("page_id") / 100)))


@query("SELECT ccn, mrf_url AS url, event_id::VARCHAR AS event_id, http_status::VARCHAR AS status FROM latest", "latest")
def s19_scoreboard_file(s, d):
    folder = sinks.scratch_path(s, "scoreboard")
    sinks.write_scoreboard(registry.latest_probes(T.probes(s, d)).select("ccn", F.col("mrf_url").alias("url"), "event_id", F.col("http_status").alias("status")), folder)
    return files.read_csv(s, folder)


@query("SELECT p_partkey AS id, p_name AS name, 'ends' AS mark FROM part")
def s1_csv_with_preamble(s, d):
    """Files with two lines of metadata before the header; some rows are equal to lines above, cells have line breaks."""
    folder = sinks.scratch_path(s, "csv")
    cell = F.concat(F.lit('"'), "p_name", F.lit('\nends"'))
    rows = T.read(s, d, "part").repartitionByRange(3, "p_partkey").groupBy(F.spark_partition_id().alias("k")).agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(","), cell))), "\n").alias("body"))
    rows.select(F.concat(F.lit("made,by\nhand,once\nid,cell\nid,cell\nhand,once\n"), "body").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    raw = files.read_csv(s, folder, 2, row="at")
    return raw.where("at > 1").select(F.col("id").cast("long").alias("id"), F.split("cell", "\n")[0].alias("name"), F.split("cell", "\n")[1].alias("mark"))


@query("""WITH x AS (SELECT ccn, seq, code, ccn::INT % 3 AS k, description || CASE WHEN ccn::INT % 3 = 1 THEN ', "big"' || chr(10) || 'size' ELSE '' END AS description, round(gross, 2) AS gross, payers FROM items WHERE code <> ''),
t AS (SELECT ccn, code, description, arg_min(coalesce(gross, -1), seq) AS gross, count_if(p.rate_dollar > 0) AS n FROM (SELECT *, unnest(payers) AS p FROM x WHERE k < 2) GROUP BY ccn, code, description),
a AS (SELECT ccn, code, description, CASE WHEN gross >= 0 THEN gross END AS gross, n FROM t UNION ALL SELECT ccn, code, description, gross, len(list_filter(payers, lambda y: y.rate_dollar > 0))::BIGINT FROM x WHERE k = 2)
SELECT ccn, code, description, gross, n, count(*) AS copies FROM a GROUP BY ALL""", "items")
def s1_many_layouts(s, d):
    """A file for each facility in one of three layouts: plain, with a preamble, a blank line and line breaks in cells, and wide."""
    x, k = T.items(s, d, "l_orderkey", "l_linenumber", "l_extendedprice").where("code <> ''"), F.col("ccn").cast("int") % 3
    text = lambda c: F.coalesce(c.cast("decimal(20,2)").cast("string"), F.lit(""))
    money, quoted = text(F.col("gross")), F.concat(F.lit('"'), "description", F.lit(', ""big""\nsize"'))
    line = lambda *cells: F.concat_ws(",", *cells)
    # a line for each payer, or for the item; payers are made where they are written, as arrays of them are made without generated code
    lines = x.withColumn("at", F.explode(F.when(k < 2, T.payer_places()).otherwise(F.array(F.lit(0)))))
    rate, payer = text(T.payer_at(F.col("at"))["rate_dollar"]), T.payer_at(F.col("at"))["payer"]
    cell = lambda i: text(F.when(F.size(T.payer_places()) >= i, T.payer_at(F.lit(i - 1))["rate_dollar"]))
    value = X.choose([(k == 0, line("code", "description", money, payer, rate)), (k == 1, line(rate, payer, quoted, money, "code"))], line("description", cell(1), cell(2), cell(3), "code", money))
    heads = ["Charge Code,Description,Gross Charge,Payer Name,Negotiated Dollar\n", 'made,by\n\n"hand,\nonce",twice\nNegotiated Dollar,Payer Name,Description,Gross Charge,Charge Code\n', "Description,Aetna,Cigna PPO,Medicare Plan,cdm_code,Gross\n"]
    folder = sinks.scratch_path(s, "layouts")
    lines = lines.select("ccn", "seq", "at", value.alias("value")).repartition("ccn").sortWithinPartitions(F.col("ccn").cast("int"), "seq", "at")
    sinks.write_texts(lines, "ccn", folder, lambda ccn: heads[int(ccn) % 3])
    out = files.ingest_files(s, folder).withColumn("ccn", F.substring_index(F.substring_index("file", "/", -1), ".", 1))
    return out.groupBy("ccn", "code", "description", "gross", F.size("payers").cast("long").alias("n")).agg(F.count("*").alias("copies"))


# ---- headers and profiles ------------------------------------------------------------------------------------------


@query("SELECT DISTINCT p_name AS header, replace(p_name, ' ', '_') AS normal, contains(p_name, 'red') OR contains(p_name, 'hot gear') AS hit FROM part")
def f1_f2_headers(s, d):
    names = T.read(s, d, "part").select("p_name").distinct()
    padded = F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))
    return names.select(F.col("p_name").alias("header"), X.norm_header(padded).alias("normal"), X.keyword_match(padded, ["red", "hot gear"]).alias("hit"))


def raw_items(s, d):
    """Items as the text rows of a file with a sparse code column, a misspelt description and an unnamed price."""
    x = T.items(s, d)
    return x.select("ccn", "seq", F.when(F.col("seq") % 3 == 0, F.col("code")).alias("CPT"), F.concat(F.lit("K"), F.col("seq") % 100).alias("Item Code"), F.col("description").alias("Descripton"), F.coalesce(F.format_string("%.2f", "gross"), F.lit("0")).alias("Amnt"))


@query("SELECT 'CPT' AS name, avg((seq % 3 = 0 AND code <> '')::INT) AS filled FROM items UNION ALL SELECT x, 1 FROM (SELECT unnest(['Item Code', 'Descripton', 'Amnt']) AS x)", "items")
def a1_column_profile(s, d):
    found = layout.profile(raw_items(s, d).drop("ccn", "seq"))
    return s.createDataFrame([(k, float(v[0])) for k, v in found.items()], "name string, filled double")


@query("SELECT ccn, 'K' || (seq % 100)::VARCHAR AS code, description, round(gross, 2) AS gross FROM items", "items")
def f4_f5_recovered_columns(s, d):
    """The full code column stands in for the sparse one, and near or numeric columns for those that no hint names."""
    raw = raw_items(s, d)
    found = files.resolve_file(raw.drop("ccn", "seq"))
    out = files.ingest_wide(raw.select("ccn", F.concat("ccn", F.lit("|"), "Descripton").alias("Descripton"), "CPT", "Item Code", "Amnt"), found)
    return out.select(F.split("description", r"\|")[0].alias("ccn"), "code", F.split("description", r"\|")[1].alias("description"), "gross")


@query("SELECT c_custkey AS id, sha256(replace(lower(c_name), ' ', '_') || '|' || replace(lower(c_mktsegment), ' ', '_'))[1:16] AS layout FROM customer")
def f6_layout_ids(s, d):
    df = T.read(s, d, "customer")
    return df.select(F.col("c_custkey").alias("id"), X.header_fingerprint(F.array("c_name", F.concat(F.lit(" "), F.upper("c_mktsegment")))).alias("layout"))


@query("""WITH x AS (SELECT ccn, seq, CASE WHEN seq % 2 = 0 THEN gross END AS a, CASE WHEN seq % 3 = 0 THEN -1 ELSE cash END AS b, max_rate AS c FROM items)
SELECT 'M' || seq::VARCHAR AS code, coalesce(a, CASE WHEN b >= 0 THEN b END, c) AS gross, CASE WHEN a IS NOT NULL THEN DATE '2025-01-01' WHEN b >= 0 THEN DATE '2024-01-01' WHEN c IS NOT NULL THEN DATE '2023-06-30' END AS day FROM x""", "items")
def f7_dated_charges(s, d):
    text = lambda c: c.cast("string")
    k = F.col("seq")
    raw = T.items(s, d).select(F.concat(F.lit("M"), "seq").alias("MNEMONIC"), F.col("description"), text(F.when(k % 2 == 0, F.col("gross"))).alias("STD CHARGE 01/01/25"), text(F.when(k % 3 == 0, -1.0).otherwise(F.col("cash"))).alias("STD CHARGE 01/01/24"), text(F.col("max_rate")).alias("STD CHARGE 06/30/23"), F.lit("9").alias("STD CHARGE 13/45/25"))
    return files.ingest_wide(raw).select("code", "gross", F.col("gross_charge_source.effective_date").alias("day"))


# ---- functions -----------------------------------------------------------------------------------------------------


@query("SELECT page_id, page_id % 5 < 3 AS asset FROM pages")
def f17_web_assets(s, d):
    name = X.choose([(F.col("page_id") % 5 == i, n) for i, n in enumerate(("favicon-32.png?x=1", "icons/a.csv", "robots.txt", "robots.csv", "prices.json"))])
    return T.read(s, d, "pages").select("page_id", X.is_web_asset(F.concat(F.lit("https://a.org/"), name)).alias("asset"))


@query("SELECT ccn, CASE WHEN score >= 80 THEN 'good' WHEN score >= 60 THEN 'fair' ELSE 'poor' END AS band, CASE WHEN n_cash = 0 THEN 'unknown' WHEN 100 * n_cash >= 75 * item_count THEN 'pass' ELSE 'fail' END AS cash FROM scores", "scores")
def f22_labels(s, d):
    df = standardize.compliance(slim(s, d))
    return df.select("ccn", X.score_band(F.col("score")).alias("band"), X.status_label(F.when(F.col("n_cash") > 0, 100 * F.col("n_cash") >= 75 * F.col("item_count"))).alias("cash"))


@query("SELECT 'S' || lpad(a.s_suppkey::VARCHAR, 6, '0') AS submission_id, lpad(a.s_suppkey::VARCHAR, 6, '0') AS ccn_claimed, lpad(b.s_suppkey::VARCHAR, 6, '0') AS named FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1 WHERE a.s_suppkey % 4 = 0")
def j15_misassigned(s, d):
    """Every fourth facility sends a file under its neighbour's name."""
    r = T.registry(s, d).withColumn("name", F.concat(F.lit("Unit "), "ccn", F.lit(" Clinic")))
    k = F.col("ccn_claimed").cast("int")
    named = F.when(k % 4 == 0, F.concat(F.lit("Clinic Unit "), T.padded(k + 1))).otherwise(F.concat(F.lit("Unit "), "ccn_claimed", F.lit(" Clinic")))
    return quality.misassigned(submissions(s, d).withColumn("hospital_name", named), r)


# ---- streams -------------------------------------------------------------------------------------------------------


@query("WITH b AS (SELECT ccn, n, cpt_indexed, ccn::INT % 3 AS k FROM idx) SELECT ccn, n, cpt_indexed + CASE WHEN k > 0 THEN 1 ELSE 0 END AS cpt_indexed FROM b", "idx")
def t3_guarded_upserts(s, d):
    """Three versions of the index; the fourth would empty priced facilities and is refused."""
    folder, x = sinks.scratch_path(s, "versions"), index(s, d)
    upsert = changes.guarded_upsert(folder, lambda batch: batch)
    upsert(x, 0)
    for k in (1, 2):
        upsert(x.where(F.col("ccn").cast("int") % 3 == k).withColumn("cpt_indexed", F.col("cpt_indexed") + 1), k)
    upsert(x.where(F.col("ccn").cast("int") % 3 == 0).withColumn("n", F.lit(0).cast("long")), 3)
    return s.read.parquet(f"{folder}/v={changes.current_version(s, folder)}")


@query("SELECT mrf_url AS url, count(*) AS n, max(event_id) AS last FROM probes GROUP BY mrf_url", "probes")
def t4_bounded_waves(s, d):
    """All files of a folder, two at a time, counted by a stream."""
    folder, out, state = (sinks.scratch_path(s, n) for n in ("wave-in", "wave-out", "wave-state"))
    T.probes(s, d).select(F.col("mrf_url").alias("url"), "event_id").repartition(7, "event_id").write.parquet(folder)
    source = changes.bounded_source(s, "url string, event_id long", folder, 2)
    source.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return s.read.schema("url string, event_id long").parquet(out).groupBy("url").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


@query("SELECT mrf_url AS url, max(probed_at) AS probed_at, arg_max(http_status, (probed_at, event_id)) AS status FROM probes GROUP BY mrf_url", "probes")
def t5_running_latest(s, d):
    events = T.probes(s, d).select(F.col("mrf_url").alias("url"), "probed_at", F.col("http_status").alias("status"), F.lpad(F.col("event_id").cast("string"), 18, "0").alias("sha256"))
    return changes.running_latest(events).drop("sha256")


@query("""WITH e AS (SELECT mrf_url AS url, probed_at, event_id, http_status AS status, sha256 FROM probes WHERE http_status IN (200, 304, 503, -1)),
p AS (SELECT *, arg_max(sha256, (probed_at, event_id)) FILTER (event_id % 2 = 0 AND status = 200) OVER (PARTITION BY url ORDER BY probed_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS consumed FROM e)
SELECT url, CASE WHEN status = 304 THEN 'unchanged' WHEN status <> 200 THEN 'error' WHEN consumed IS NULL THEN 'new' WHEN consumed <> sha256 THEN 'changed' ELSE 'same' END AS verdict, count(*) AS n FROM p GROUP BY ALL""", "probes")
def t2_consumed_changes(s, d):
    """A stream of probes in which every second good answer is then consumed: a change stays one until it is."""
    x = T.probes(s, d).where("http_status IN (200, 304, 503, -1)").select(F.col("mrf_url").alias("url"), F.lit("probe").alias("kind"), (F.col("probed_at") + F.expr("make_dt_interval(0, 0, 0, event_id % 1000 / 1000000)")).alias("probed_at"), F.col("http_status").alias("status"), "sha256", F.lit(False).alias("indexed"), "event_id")
    used = x.where("event_id % 2 = 0 AND status = 200").withColumn("kind", F.lit("consumed")).withColumn("status", F.lit(None).cast("int")).withColumn("probed_at", F.col("probed_at") + F.expr("make_dt_interval(0, 0, 0, 0.0000005)"))
    folder, out, state = (sinks.scratch_path(s, n) for n in ("events-in", "events-out", "events-state"))
    x.unionByName(used).drop("event_id").write.parquet(folder)
    source = changes.bounded_source(s, "url string, kind string, probed_at timestamp, status int, sha256 string, indexed boolean", folder, 1_000_000)
    changes.detect_changes(source).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return s.read.schema(changes.VERDICTS).parquet(out).where("verdict <> 'consumed'").groupBy("url", "verdict").agg(F.count("*").alias("n"))


def waves_of(s, df, batch, n, stream):
    """Writes each batch of ``df`` to a folder and runs ``stream(source)`` to its end before the next one comes: n runs of one query."""
    folder = sinks.scratch_path(s, "waves-in")
    rest = df.drop("__batch")
    for k in range(n):
        df.withColumn("__batch", batch).where(F.col("__batch") == k).drop("__batch").write.mode("append").parquet(folder)
        stream(s.readStream.schema(rest.schema).parquet(folder)).trigger(availableNow=True).start().awaitTermination()


@query("""WITH e AS (SELECT mrf_url AS url, probed_at + INTERVAL (event_id % 1000) MICROSECOND AS t, http_status AS status, sha256, ccn::INT % 3 AS k, event_id % 5 = 0 AS second FROM probes),
g AS (SELECT url, min(t) AS gone FROM e WHERE NOT second AND status = 404 GROUP BY url),
l AS (SELECT e.url, max(t) AS last FROM e LEFT JOIN g USING (url) WHERE NOT second AND status IN (200, 304, 404) AND (gone IS NULL OR t <= gone) GROUP BY e.url),
h AS (SELECT e.url, min(t) AS gone2 FROM e LEFT JOIN g USING (url) LEFT JOIN l USING (url) WHERE second AND status = 404 AND gone IS NULL AND (last IS NULL OR t >= last) GROUP BY e.url),
v AS (SELECT e.*, CASE WHEN NOT second AND t > gone OR second AND (gone IS NOT NULL OR t < last OR t > gone2) THEN 'ignored' WHEN status = 404 THEN 'dead' WHEN status = 304 THEN 'unchanged' WHEN status <> 200 THEN 'error'
    WHEN k = 0 THEN CASE WHEN sha256 = '3' THEN 'same' ELSE 'changed' END WHEN k = 1 THEN 'baseline' ELSE 'new' END AS verdict FROM e LEFT JOIN g USING (url) LEFT JOIN l USING (url) LEFT JOIN h USING (url))
SELECT url, verdict, count(*) AS n FROM v GROUP BY ALL""", "probes")
def t1_change_stream(s, d):
    """Two runs of one query: state begins with the published index, the second run brings late events, dead URLs stay dead."""
    x, k = T.probes(s, d), F.col("ccn").cast("int") % 3
    index = x.where(k < 2).select(F.col("mrf_url").alias("url"), F.when(k == 0, "3").alias("consumed"), F.lit(True).alias("indexed")).distinct()
    events = x.select(F.col("mrf_url").alias("url"), F.lit("probe").alias("kind"), (F.col("probed_at") + F.expr("make_dt_interval(0, 0, 0, event_id % 1000 / 1000000)")).alias("probed_at"), F.col("http_status").alias("status"), "sha256", "event_id")
    out, state = (sinks.scratch_path(s, n) for n in ("verdicts", "verdicts-state"))
    with stateful.state_in_rocksdb(s):
        waves_of(s, events, (F.col("event_id") % 5 == 0).cast("int"), 2, lambda source: stateful.detect_changes(source.drop("event_id"), index).writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
    return s.read.schema(stateful.VERDICTS).parquet(out).groupBy("url", "verdict").agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT (ccn::INT % 8)::INT AS lane, mrf_url AS url, event_id, event_id % 4 + 1 AS came FROM probes),
r AS (SELECT *, (row_number() OVER (PARTITION BY lane ORDER BY came, event_id) - 1) // 5 + 1 AS wave FROM x)
SELECT lane, wave, came < wave AS deferred, url, event_id FROM r WHERE wave <= 4""", "probes")
def t4_deferred_waves(s, d):
    """Four waves of five rows a lane: what a wave has to defer comes first in the next one, in the order of arrival."""
    x = T.probes(s, d).select(F.col("mrf_url").alias("url"), "event_id", F.col("ccn").cast("int").alias("facility"))
    out, state = (sinks.scratch_path(s, n) for n in ("queue", "queue-state"))
    with stateful.state_in_rocksdb(s):
        waves_of(s, x, F.col("event_id") % 4, 4, lambda source: stateful.bounded_waves(source, 5, 8, ["event_id"], F.col("facility")).writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
    return s.read.parquet(out).drop("facility")


@query("SELECT i.ccn, n, cpt_indexed, score, grade FROM idx i JOIN scores USING (ccn)", "idx", "scores")
def t3_incremental_index(s, d):
    """A stream of changed facilities in three waves, of which each recomputes its own facilities' rows: the index equals a rebuild."""
    items, registry_ = T.items(s, d), T.registry(s, d)
    store, folder, state = (sinks.scratch_path(s, n) for n in ("items", "index", "index-state"))
    changes.stored_by_bucket(items, store)
    upsert = changes.guarded_upsert(folder, lambda batch: changes.recomputed(store, registry_, batch))
    waves_of(s, items.select("ccn").distinct(), F.col("ccn").cast("int") % 3, 3, lambda source: source.writeStream.foreachBatch(upsert).option("checkpointLocation", state))
    return s.read.parquet(f"{folder}/v={changes.current_version(s, folder)}").select("ccn", "n", "cpt_indexed", "score", "grade")


@query("SELECT mrf_url AS url, max(probed_at) AS probed_at, arg_max(http_status, (probed_at, event_id)) AS status FROM probes GROUP BY mrf_url", "probes")
def t5_running_stream(s, d):
    """The latest probe of each URL by a stream in update mode, in three runs; each batch writes the rows that it changed."""
    events = T.probes(s, d).select(F.col("mrf_url").alias("url"), "probed_at", F.col("http_status").alias("status"), F.lpad(F.col("event_id").cast("string"), 18, "0").alias("sha256"), "event_id")
    folder, state = sinks.scratch_path(s, "latest"), sinks.scratch_path(s, "latest-state")
    waves_of(s, events, F.col("event_id") % 3, 3, lambda source: changes.running_latest(source).writeStream.outputMode("update").foreachBatch(changes.latest_by_batch(folder)).option("checkpointLocation", state))
    return changes.read_latest(s, folder, "url").drop("sha256")


_KEYED = {
    "items": ("slim", "ccn", "000007", "pc"), "entries": ("entries", "code", "00004", "pc"), "index": ("idx", "ccn", "000007", "n"), "coverage": ("(SELECT code, count(*) AS n FROM entries GROUP BY code)", "code", "00004", "n"),
    "registry": ("registry", "ccn", "000007", "length(name)"), "scores": ("scores", "ccn", "000007", "score"),
}


@query("WITH one AS (" + " UNION ALL ".join(f"SELECT '{name}' AS product, count(*) AS n_rows, sum({value})::BIGINT AS total, least(count(*), 1) AS n_files FROM {table} WHERE {key} = '{wanted}'" for name, (table, key, wanted, value) in _KEYED.items()) + """)
SELECT 1 AS generation, * FROM one UNION ALL SELECT 2, product, CASE WHEN product = 'index' THEN 0 ELSE n_rows END, CASE WHEN product <> 'index' THEN total END, CASE WHEN product = 'index' THEN 0 ELSE n_files END FROM one""", "registry", "entries", "idx", "scores")
def s18_generations(s, d):
    """Six products published together, twice; one key of each read from the generation pinned before the second, and from that.

    The second lacks the facility in its index and names the other products where they lie. All but the registry are made
    from the published items. Files: those that the read of the key found rows in."""
    folder, r = f"{sinks.scratch_path(s, 'products')}/published", T.registry(s, d)
    products = {
        "items": (slim(s, d), "ccn"), "entries": (lambda p: indexes.code_entries(p["items"]), "code"), "scores": (lambda p: standardize.compliance(p["items"]), "ccn"),
        "index": (lambda p: indexes.facility_index(p["items"], p["scores"], r).select("ccn", "n", "cpt_indexed"), "ccn"),
        "coverage": (lambda p: p["entries"].groupBy("code").agg(F.count("*").alias("n")), "code"), "registry": (r, "ccn"),
    }
    pinned = sinks.publish(s, products, folder, 16)
    fewer = pinned.read("index").where("ccn <> '000007'")
    sinks.publish(s, {"index": (fewer, "ccn")}, folder, 16, [name for name in products if name != "index"])
    parts = []
    for g in (pinned, sinks.generation(s, folder)):
        for name, (_, _, wanted, value) in _KEYED.items():
            one = g.read(name, wanted).select(F.expr(value).cast("long").alias("value"), F.input_file_name().alias("file"))
            parts.append(one.agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"), F.count_distinct("file").alias("n_files")).select(F.lit(g.number).cast("int").alias("generation"), F.lit(name).alias("product"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query(None)
def u7_merged_states(s, d):
    """Three waves that each leave their state behind, merged from the states alone."""
    folder = sinks.scratch_path(s, "waves")
    indexes.code_entries(slim(s, d)).withColumn("wave", F.pmod(F.xxhash64("ccn"), F.lit(3)).cast("int")).write.partitionBy("wave").parquet(f"{folder}/entries")
    x = s.read.parquet(f"{folder}/entries")
    for i in range(3):
        codes, owners = merges.wave_state(x.where(F.col("wave") == i).drop("wave"), 5)
        codes.write.parquet(f"{folder}/codes/wave={i}")
        owners.write.parquet(f"{folder}/owners/wave={i}")
    merged = merges.merged_states(s.read.parquet(f"{folder}/codes"), s.read.parquet(f"{folder}/owners"), 40, 5)
    return merged.select("code", "n_entries", "facilities", F.array_join("entries.ccn", ",").alias("ccns"))


SQL["u7_merged_states"] = SQL["u7_merged_waves"]


@query("SELECT strlen(ccn || ' ' || name) + 1 AS bytes, sha256(ccn || ' ' || name || chr(10)) AS sha256, count(*) AS n FROM registry GROUP BY ALL", "registry")
def s20_manifest(s, d):
    """Bytes and hashes of files that are written first, one for each facility."""
    folder = sinks.scratch_path(s, "outputs")
    one_each(spread(T.registry(s, d)).select(F.concat_ws(" ", "ccn", "name").alias("value"))).text(folder)
    return sinks.build_manifest(s, folder, "*.txt").groupBy("bytes", "sha256").agg(F.count("*").alias("n"))
