"""Readers and the column resolver on generated files."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from pricefold.sources import delimited, files, layout, sinks, web


def write(path, text):
    path.write_text(text)
    return str(path)


def test_tall_file(spark, tmp_path):
    path = write(tmp_path / "tall.csv", "code,description,setting,gross charge,discounted_cash,payer_name,plan_name,negotiated_rate,min_negotiated,max_negotiated\n99213,Visit,op,$100,60,Aetna,PPO,80,70,90\n99213,Visit,op,999,61,Cigna,,75,70,90\n99213,Visit,op,,,,,10,,\n470,Joint,ip,5000,,Aetna,HMO,0,,\n")
    rows = {r.code: r for r in files.ingest_tall(files.read_csv(spark, path)).collect()}
    v = rows["99213"]
    assert (v.code_type, v.gross, v.cash, v.min_rate, v.max_rate, v.setting) == ("CPT", 100.0, 60.0, 70.0, 90.0, "op")
    assert [(p.payer, p.plan, p.rate_dollar) for p in v.payers] == [("Aetna", "PPO", 80.0), ("Cigna", "", 75.0)]
    assert rows["470"].code_type == "DRG" and rows["470"].payers == []


def test_wide_file_with_preamble(spark, tmp_path):
    path = write(tmp_path / "wide.csv", "hospital_name,last_updated_on\nMercy,2025-01-31\nCode,Description,Gross,Cash,Aetna Commercial,Medicare\n99213,Visit,100,50,80,0\n,No code,,,7,\n,Nothing,,,,\n")
    head = (tmp_path / "wide.csv").read_text().splitlines()
    lines = delimited.staged_lines(spark, path)
    assert delimited.headers(lines, delimited.records(lines)).first().header[:2] == ["Code", "Description"]
    rows = {r.description: r for r in files.ingest_wide(files.read_csv(spark, path, 2)).collect()}
    assert set(rows) == {"Visit", "No code"}
    assert [(p.payer, p.rate_dollar) for p in rows["Visit"].payers] == [("Aetna Commercial", 80.0)]
    text = spark.createDataFrame([("\n".join(head),), ('{"last_updated_on": "1/2/2024"}',), ('{"last_updated_on": "2040-01-01"}',)], "t string")
    assert [str(r[0]) for r in text.select(files.declared_date(F.col("t"))).collect()] == ["2025-01-31", "2024-01-02", "None"]


def test_layouts(spark):
    full = lambda cols, **kw: {c: kw.get(c.replace(" ", "_"), (1.0, 1.0)) for c in cols}
    cols = ["CHARGE_CODE", "CPT_CODE", "description", "price"]
    assert layout.resolve(cols, full(cols)).roles["code"] == "CHARGE_CODE"
    cols = ["CPT", "Item Code", "description", "price"]
    sparse = layout.resolve(cols, full(cols, CPT=(0.1, 1.0)))
    assert sparse.roles["code"] == "Item Code" and "gives way" in sparse.notes[0]
    cols = ["Service Code", "Service Descrption", "Charge"]
    got = layout.resolve(cols, full(cols))
    assert (got.roles["code"], got.roles["desc"], got.roles["gross"]) == ("Service Code", "Service Descrption", "Charge")
    cols = ["code", "descripton", "prise"]
    got = layout.resolve(cols, full(cols, descripton=(1.0, 0.0)))
    assert got.roles["desc"] == "descripton" and got.roles["gross"] == "prise"
    assert layout.layout_id(["A b", "c"]) == layout.layout_id(["a-B", "C"]) != layout.layout_id(["c", "a b"])
    known = layout.resolve(["x", "y"], full(["x", "y"]), {layout.layout_id(["x", "y"]): {"code": "x", "desc": "y"}})
    assert known.roles["code"] == "x"


def test_dated_charges(spark):
    cols = ["MNEMONIC", "description", "STD CHARGE 01/01/24", "STD CHARGE 01/01/25", "STD CHARGE 13/45/25", "STD CHARGE 01/01/23"]
    df = spark.createDataFrame([("A1", "x", "10", "", "99", "5"), ("A2", "y", "-3", "n/a", "99", "5"), ("A3", "z", "", "0", "1", "")], ", ".join(f"`{c}` string" for c in cols))
    got = files.resolve_file(df)
    assert got.roles["code"] == "MNEMONIC" and got.roles["gross"] == "STD CHARGE 01/01/25"
    rows = {r.code: r for r in files.ingest_wide(df, got).collect()}
    assert (rows["A1"].gross, str(rows["A1"].gross_charge_source.effective_date)) == (10.0, "2024-01-01")
    assert rows["A2"].gross == 5.0 and rows["A3"].gross == 0.0 and rows["A1"].code_type == "CDM"


DOCUMENT = {
    "hospital_name": "Mercy", "last_updated_on": "2025-01-01", "version": "3.0.0", "hospital_address": "1 Main St, Salem, OR 97301", "license_information": {"license_number": "77", "state": "OR"},
    "standard_charge_information": [
        {"description": "Visit", "code_information": [{"code": "99213", "type": "CPT"}, {"code": "510", "type": "RC"}], "standard_charges": [
            {"setting": "outpatient", "gross_charge": 100, "discounted_cash": "60", "minimum": 1, "maximum": 2, "payers_information": [{"payer_name": "Aetna", "plan_name": "PPO", "standard_charge_dollar": 80, "methodology": "fee schedule"}]}, {"setting": "inpatient", "gross_charge": 200}]},
        {"description": "Bare", "code": "J1234", "standard_charges": [{"gross_charge": "5"}]},
    ],
}


def test_documents(spark, tmp_path):
    path = write(tmp_path / "doc.json", json.dumps(DOCUMENT))
    docs = files.read_documents(spark, path)
    rows = files.ingest_documents(docs).orderBy("seq").collect()
    assert [(r.code, r.code_type, r.setting, r.gross) for r in rows] == [("99213", "CPT", "outpatient", 100.0), ("99213", "CPT", "inpatient", 200.0), ("J1234", "HCPCS", "", 5.0)]
    assert rows[0].payers[0].rate_dollar == 80.0 and rows[1].payers == []
    h = files.extract_header(docs).first()
    assert (h.hospital_name, h.city.strip(), h.state, h.zip, h.license) == ("Mercy", "Salem", "OR", "97301", "77")


def test_xml(spark, tmp_path):
    path = write(tmp_path / "doc.xml", "<root><hospital><hospital_name>M</hospital_name><standard_charge_information><description>V</description><code_information><code>99213</code><type>CPT</type></code_information><standard_charges><gross_charge>7</gross_charge></standard_charges></standard_charge_information></hospital></root>")
    rows = files.ingest_documents(files.read_xml(spark, path)).collect()
    assert [(r.code, r.description, r.gross) for r in rows] == [("99213", "V", 7.0)]


def test_vendor_rows(spark):
    data = [({"Code": "99213", "Description": "V", "Payer": "Aetna", "Rate": "5", "Gross Charge": "9"},), ({"Code": "99213", "Description": "V", "Payer": "Cigna", "Min": "4", "Max": "4"},), ({"CPT": "99214", "service": "W", "Medicare Advantage": "3", "mod": "x"},)]
    rows = {r.code: r for r in files.ingest_vendor_rows(spark.createDataFrame(data, "row map<string,string>").coalesce(1)).collect()}
    assert sorted((p.payer, p.rate_dollar) for p in rows["99213"].payers) == [("Aetna", 5.0), ("Cigna", 4.0)] and rows["99213"].gross == 9.0
    assert [(p.payer, p.rate_dollar) for p in rows["99214"].payers] == [("Medicare Advantage", 3.0)]


def test_sniffing_corpus_and_manifest(spark, tmp_path):
    blobs = {"a.bin": b"PK\x03\x04", "b.txt": b"\xef\xbb\xbf {\"x\": 1}", "c": b"<!DOCTYPE html>", "d": b"<?xml version='1.0'?>", "e": b"a,b,c\n1,2,3", "f.json": b"zzz", "h.xlsx": b"PK\x03\x04"}
    for name, raw in blobs.items():
        (tmp_path / name).write_bytes(raw)
    df = spark.read.format("binaryFile").load(str(tmp_path))
    got = {r.p.rsplit("/", 1)[1]: r.f for r in df.select(F.col("path").alias("p"), files.sniff_format(F.col("content"), F.col("path")).alias("f")).collect()}
    assert got == {"a.bin": "zip", "b.txt": "json", "c": "html", "d": "xml", "e": "csv", "f.json": "json", "h.xlsx": "xlsx"}
    manifest = sinks.build_manifest(spark, str(tmp_path), "e")
    assert [(r.path, r.bytes) for r in manifest.collect()] == [("e", 11)]
    corpus = tmp_path / "corpus"
    corpus.mkdir()
    (corpus / "1.json").write_text(json.dumps({"ccn": "000001", "v": "plain"}))
    (corpus / "1.json.gz").write_bytes(gzip.compress(json.dumps({"ccn": "000001", "v": "old"}).encode()))
    (corpus / "2.json.gz").write_bytes(gzip.compress(json.dumps({"ccn": "000002", "v": "only"}).encode()))
    (corpus / "3.json").write_text("{broken")
    assert {r.ccn: r.v for r in files.read_corpus(spark, str(corpus), "v string").collect()} == {"000001": "plain", "000002": "only"}


def test_registries(spark, tmp_path):
    rows = spark.createDataFrame([("1", "u", "a", 1), ("1", "u", "b", 2), ("", "u", "c", 3), (None, "u", "d", 4)], "ccn string, mrf_url string, name string, ordinal int")
    assert [r.name for r in files.load_registry(rows.where("ccn = '1'").drop("mrf_url")).collect()] == ["b"]
    assert [r.name for r in files.load_seeds(rows).collect()] == ["a"]
    path = write(tmp_path / "cases.csv", "case_id,date_of_action\nA,12/31/2023\nB,1/2/2024\n")
    assert [r.case_id for r in files.load_enforcement(spark, path).orderBy("date_of_action").collect()] == ["A", "B"]
    path = write(tmp_path / "log.jsonl", '{"ccn": "1"}\n\nbroken\n{"ccn": "2"}\n')
    assert files.read_jsonl(spark, path, "ccn string").count() == 2


def test_web(spark):
    html = '<A class="x" href="/files/12_standardcharges.csv">Machine-readable</A> <a href="mailto:a@b.c">m</a> <a href="next.html"><b>n</b></a> <a href="//cdn.org/x.zip">z</a><a href="/manifest.json">standard charges</a>'
    pages = spark.createDataFrame([(1, "https://a.org/dir/page?x=1", html)], "page_id long, url string, html string")
    assert [r.href for r in web.anchors(pages).orderBy("at").collect()] == ["https://a.org/files/12_standardcharges.csv", "https://a.org/dir/next.html", "https://cdn.org/x.zip", "https://a.org/manifest.json"]
    got = web.top_links(web.harvest_links(pages)).orderBy("rank").collect()
    assert [(r.href, r.score) for r in got] == [("https://a.org/files/12_standardcharges.csv", 13), ("https://cdn.org/x.zip", 3)]
    maps = spark.createDataFrame([(1, "<loc> https://a.org/standard-charges.json </loc><loc>https://a.org/about</loc>")], "page_id long, xml string")
    assert [r.score for r in web.harvest_sitemap(maps).collect()] == [10]
    blocks = spark.createDataFrame([(1, "location-name: Mercy\nmrf-url: https://a.org/x.csv\ncontact-email: Me@A.org\n\nlocation-name: No url\n\n\nmrf-url: y\nlocation-name: N")], "id long, text string")
    assert [(r.name, r.url) for r in web.location_blocks(blocks).orderBy("at").collect()] == [("Mercy", "https://a.org/x.csv"), ("N", "y")]
    assert [r.domain for r in web.email_domains(blocks).collect()] == ["a.org"]


def test_products(spark, tmp_path):
    df = spark.createDataFrame([(f"{i:06d}", i) for i in range(50)], "ccn string, n long")
    sinks.write_products({"index": (df, "ccn")}, str(tmp_path / "out"), 8)
    assert spark.read.parquet(str(tmp_path / "out/index")).count() == 50
    sinks.write_documents(df, str(tmp_path / "docs"))
    assert spark.read.json(str(tmp_path / "docs")).count() == 50
    sinks.write_scoreboard(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["ccn", "n"]


def test_generations(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    assert sinks.generation(spark, folder) is None
    df = spark.createDataFrame([(f"{i:06d}", i) for i in range(50)] + [("000007", None)], "ccn string, n long")
    codes = spark.createDataFrame([(5, "a"), (6, "b")], "code long, text string")
    first = sinks.publish(spark, {"index": (df, "ccn"), "codes": (codes, "code")}, folder, 8)
    pinned = sinks.generation(spark, folder)
    assert (pinned.number, pinned.path, pinned.products) == (1, first.path, {"index": ("ccn", 8, 51), "codes": ("code", 8, 2)})
    # a run that dies before its manifest leaves readers where they were
    sinks.write_products({"index": (df.limit(1), "ccn")}, f"{folder}/generations/2-dead", 8)
    assert sinks.generation(spark, folder).path == first.path
    sinks.publish(spark, {"index": (df.where("ccn <> '000007'"), "ccn")}, folder, 4)
    assert sinks.generation(spark, folder).number == 2 and sinks.generation(spark, folder).products == {"index": ("ccn", 4, 49)}
    assert pinned.read("index", "000007").count() == 2 and sinks.generation(spark, folder).read("index", "000007").count() == 0
    assert sinks.generation(spark, folder, 1).read("index").count() == 51 and sinks.generation(spark, folder, 9) is None
    assert [r.text for r in pinned.read("codes", 6).collect()] == ["b"]
    plan = pinned.read("index", "000007")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    empty = sinks.publish(spark, {"index": (df.where("false"), "ccn")}, folder)
    assert empty.products["index"][2] == 0


def test_unchanged_products_are_not_written_again(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    df = spark.createDataFrame([(f"{i:06d}", i) for i in range(50)], "ccn string, n long")
    products = {"index": (df, "ccn"), "sums": (lambda p: p["index"].selectExpr("ccn", "n + 1 AS n"), "ccn")}
    first = sinks.publish(spark, products, folder, 8)
    for k in (2, 3):  # one carried over twice lies where it was written
        g = sinks.publish(spark, {"index": (first.read("index").where(f"n >= {k}"), "ccn")}, folder, 4, ["sums"])
        assert g == sinks.generation(spark, folder) and g.products == {"index": ("ccn", 4, 50 - k), "sums": ("ccn", 8, 50)}
        assert [r.n for r in g.read("sums", "000007").collect()] == [8] and g.read("index").count() == 50 - k
    assert len(list(tmp_path.glob("out/generations/*/index"))) == 3 and len(list(tmp_path.glob("out/generations/*/sums"))) == 1
    for name in ("index", "other"):
        with pytest.raises(ValueError):
            sinks.publish(spark, {"index": (df, "ccn")}, folder, 4, [name])


def test_formats_of_bytes_that_are_not_utf8(spark):
    """Other encodings, binary content and a character that the sniffed part splits."""
    cases = [("latin", "größe;b;c\n1;2;3".encode("latin-1"), "csv"), ("packed", bytes.fromhex("1F8B0800FF"), "gzip"), ("noise", b"\x80\x81\xff", "unknown"), ("split", b'{"a": "' + b"x" * 2040 + "é".encode() + b'"}', "json")]
    df = spark.createDataFrame([(n, bytearray(c), w) for n, c, w in cases], "name string, content binary, want string").repartition(2)
    got = df.select("name", "want", files.sniff_format(F.col("content"), F.col("name")).alias("format")).collect()
    assert {r.name: r.format for r in got} == {r.name: r.want for r in got}


def test_rows_that_become_files_are_dealt_over_tasks(spark):
    """A small table is one partition as read; its files are written by as many tasks as shuffles have."""
    from pricefold.plans.source_queries import spread

    assert spread(spark.range(40).coalesce(1)).rdd.getNumPartitions() == 4
