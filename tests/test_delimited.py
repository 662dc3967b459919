"""Delimited files of many layouts: records against the csv module, headers, roles and items in one plan."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from pricefold.sources import delimited, files, layout, sinks


@pytest.fixture
def blocks(spark):
    """Small blocks, so that small files have many."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "700b")
    yield
    spark.conf.set(name, before)


def test_records_against_the_csv_module(spark, tmp_path, blocks):
    rng = random.Random(7)
    cell = lambda breaks: rng.choice(["", "x", "a b", '6" bolt', 'say ""', "é,ü", "1,200", '"', *(["two\nlines", 'q"\n\n,"', "\n"] if breaks else [])])
    want = {}
    for name, breaks in (("plain", False), ("broken", True), ("more", True)):
        rows = [[f"{name}{i}", *(cell(breaks and rng.random() < 0.3) for _ in range(3))] for i in range(200)]
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows(rows)
        with open(tmp_path / f"{name}.csv", "a") as f:
            f.write('tail,6" pipe,9" nail,"closed"\n')  # quotes in bare cells don't count
        with open(tmp_path / f"{name}.csv", newline="") as f:
            want[name] = list(csv.reader(f))
    lines = delimited.staged_lines(spark, str(tmp_path))
    assert lines.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.min("n")).first()[0] > 5  # several tasks read a file
    got = delimited.records(lines).select("file", "block", "id", delimited.split_cells(F.col("value")).alias("cells")).orderBy("file", "block", "id").collect()
    for name, rows in want.items():
        assert [list(r.cells) for r in got if f"/{name}.csv" in r.file] == rows


def test_stray_quote_does_not_swallow_a_file(spark, tmp_path, blocks, monkeypatch):
    monkeypatch.setattr(delimited, "MOST_LINES", 20)
    (tmp_path / "a.csv").write_text("id,cell\n" + '0,"open\n' + "".join(f"{i},x\n" for i in range(1, 100)))
    assert delimited.records(delimited.staged_lines(spark, str(tmp_path))).count() == 101


def test_read_csv_with_blank_lines_and_broken_preamble(spark, tmp_path):
    (tmp_path / "a.csv").write_text("made,by\n\nid,cell\n1,a\n2,b\n")
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "a.csv"), 2).collect())) == [("1", "a"), ("2", "b")]
    (tmp_path / "b.csv").write_text('made,"by\nhand"\nid,cell\n1,a\n\n2,"b\nc"\n')
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "b.csv"), 1, row="at").collect())) == [("1", "a", 0), ("2", "b\nc", 2)]
    assert files.read_csv(spark, str(tmp_path / "b.csv"), 9).count() == 0


def test_read_csv_takes_each_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,price\nA,1\n")
    (tmp_path / "b.csv").write_text("price,code,more\n30,B,x\n")
    got = files.read_csv(spark, str(tmp_path)).select("code", "price", "more").collect()
    assert sorted(map(str, map(tuple, got))) == ["('A', '1', None)", "('B', '30', 'x')"]


LAYOUTS = {
    "tall": "Hospital,Last Updated\nMercy,2025-01-31\n\nCode,Description,Gross Charge,Payer Name,Plan,Negotiated Rate\n99213,Visit,$100,Aetna,PPO,80\n99213,Visit,999,Cigna,,75\n470,Joint,5000,Aetna,HMO,0\n",
    "wide": "﻿Medicare,Aetna Commercial,Cash,Gross,Description,Code\n0,80,50,100,Visit,99213\n,7,,,No code,\n,,,,Nothing,\n",
    "dated": 'note\n"Over, two\nlines"\nSTD CHARGE 01/01/24,MNEMONIC,description,STD CHARGE 01/01/25,CPT\n10,A1,x,,\n-3,A2,y,4,99213\n',
    "sparse": "CPT,Item Code,Descripton,Amont\n" + "".join(f",K{i},thing {i},{i}.5\n" for i in range(5)) + "99213,K9,visit,9\n",
}


def test_many_layouts_in_one_plan(spark, tmp_path):
    for name, text in LAYOUTS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    out = files.ingest_files(spark, str(tmp_path))
    rows = {(r.file.split("/")[-1][:-4], r.description): r for r in out.collect()}
    assert len({r.layout for r in rows.values()}) == 4
    visit = rows["tall", "Visit"]
    assert (visit.code, visit.code_type, visit.gross) == ("99213", "CPT", 100.0) and [(p.payer, p.plan, p.rate_dollar) for p in visit.payers] == [("Aetna", "PPO", 80.0), ("Cigna", "", 75.0)]
    assert rows["tall", "Joint"].payers == [] and ("wide", "Nothing") not in rows
    assert [(p.payer, p.rate_dollar) for p in rows["wide", "Visit"].payers] == [("Aetna Commercial", 80.0)] and (rows["wide", "Visit"].gross, rows["wide", "Visit"].cash) == (100.0, 50.0)
    assert (rows["dated", "x"].code, rows["dated", "x"].gross, str(rows["dated", "x"].gross_charge_source.effective_date)) == ("A1", 10.0, "2024-01-01") and rows["dated", "y"].gross == 4.0
    assert (rows["sparse", "thing 3"].code, rows["sparse", "thing 3"].gross) == ("K3", 3.5)
    learned = spark.createDataFrame([(layout.layout_id(["CPT", "Item Code", "Descripton", "Amont"]), {"code": "CPT", "desc": "Item Code"})], "layout string, roles map<string,string>")
    again = {r.description: r for r in files.ingest_files(spark, str(tmp_path), learned=learned).where("file LIKE '%sparse%'").collect()}
    assert again["K9"].code == "99213"
    assert files.ingest_files(spark, str(tmp_path), header_row=500).count() == 0


def test_same_items_as_file_by_file(spark, tmp_path, blocks):
    rng = random.Random(3)
    rows = [f"{rng.randint(1, 40):05d},Item {rng.randint(1, 40)},{rng.randint(1, 99)},{rng.choice(['Aetna', 'Cigna', ''])},{rng.randint(0, 9)}" for _ in range(400)]
    (tmp_path / "a.csv").write_text("Code,Description,Gross,Payer Name,Negotiated Rate\n" + "\n".join(rows) + "\n")
    one = files.ingest_tall(files.read_csv(spark, str(tmp_path), row="at"), row="at")
    key = lambda df: sorted((r.code, r.description, r.gross, [(p.payer, p.rate_dollar) for p in r.payers]) for r in df.collect())
    assert key(files.ingest_files(spark, str(tmp_path))) == key(one)


def test_many_files_without_a_folder_each_and_without_a_process_each(spark, tmp_path):
    """Files come whole and by name, a key's lines in order, also over several batches (F1)."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(100).select((F.col("id") % 9).alias("k"), "id", F.concat(F.lit("é "), "id").alias("value"))
        n = sinks.write_texts(df.repartition(3, "k").sortWithinPartitions("k", "id"), "k", str(tmp_path / "out"), lambda k: f"head {k}\n")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert n == 9 and sorted(x.name for x in (tmp_path / "out").iterdir()) == [f"{k}.txt" for k in range(9)]
    for k in range(9):
        assert (tmp_path / "out" / f"{k}.txt").read_text() == "".join([f"head {k}\n", *(f"é {i}\n" for i in range(k, 100, 9))])


def test_paths_travel_as_numbers(spark, tmp_path):
    """Items' folding and joins go by a number for each file, not by its path; paths come back at the end (F1)."""
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("Code,Description,Gross,Payer Name,Negotiated Rate\n99213,Visit,5,Aetna,3\n99213,Visit,6,Cigna,4\n")
    out = files.ingest_files(spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    folded = [x for x in plan.splitlines() if "Aggregate" in x and "k1" in x]
    assert folded and not any("path" in x for x in folded)
    assert sorted((r.file.rsplit("/", 1)[1], r.code, r.gross, [p.payer for p in r.payers]) for r in out.collect()) == [("a.csv", "99213", 5.0, ["Aetna", "Cigna"]), ("b.csv", "99213", 5.0, ["Aetna", "Cigna"])]
    lines = delimited.staged_lines(spark, str(tmp_path))
    assert dict(delimited.numbered(lines)[0].dtypes)["file"] == "bigint"


def test_files_with_one_number_are_numbered_anew(spark, tmp_path, monkeypatch):
    """Two paths never share a number (F1)."""
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text(f"Code,Gross\n{name},1\n")
    hashed, seeds = F.xxhash64, []

    def poor(path, seed):
        seeds.append(seed)
        return hashed(path, seed) % 1 if len(seeds) == 1 else hashed(path, seed)

    lines = delimited.staged_lines(spark, str(tmp_path))
    monkeypatch.setattr(delimited.F, "xxhash64", poor)
    numbered, by_file = delimited.numbered(lines)
    assert len(seeds) == 2 and by_file.select("file").distinct().count() == 3 and numbered.select("file").distinct().count() == 3


def test_single_quotes_by_the_csv_modules_rules(spark):
    """A line's only quote opens a cell or closes one, or stands in a bare cell (F1)."""
    want = {'"a': (True, False), 'x,"a,b': (True, False), 'x"': (False, False), 'a",b': (False, False), '6" x': (False, False), "": (False, True), 'x,""': (False, False), 'x,"a",y': (False, True), 'x,"a"",': (True, False)}
    df = spark.createDataFrame([(k,) for k in want], "value string")
    outside, inside = delimited.quote_steps(F.col("value"), ",")
    got = {r.value: (r.o, r.i) for r in df.select("value", outside.alias("o"), inside.alias("i")).collect()}
    d = ","
    old = {r.value: (r.o, r.i) for r in df.select("value", *_by_regex(F.col("value"), d)).collect()}
    assert got == old and all(got[k] == want[k] for k in ('"a', 'x,"a,b', 'x"', 'a",b', '6" x', "", 'x,"a"",'))


def _by_regex(value, d):
    rest = r'[^"]*+(?:""[^"]*+)*+'
    open_end = rf'(?:(?:"{rest}"[^{d}]*+|(?!")[^{d}]*+){d})*+"{rest}$'
    quoted = value.contains('"')
    return F.when(quoted, value.rlike(f"^{open_end}")).otherwise(False).alias("o"), F.when(quoted, value.rlike(rf'^{rest}(?:$|"[^{d}]*+{d}{open_end})')).otherwise(True).alias("i")


def test_files_of_one_block_are_dealt_out_once(spark, tmp_path):
    """What mends the lines of a file of one block is planned over one exchange, and a file's resolver isn't put into one task (F1)."""
    (tmp_path / "a.csv").write_text('Code,Description\n1,"a\nb"\n2,c\n')
    lines, by_file = delimited.numbered(delimited.staged_lines(spark, str(tmp_path)))
    seen, stored = [], delimited._stored
    delimited._stored = lambda df, name, **how: (seen.append((name, df)), stored(df, name, **how))[1]
    try:
        recs = delimited.records(lines, by_file)
    finally:
        delimited._stored = stored
    (name, mended), = seen
    plan = mended._jdf.queryExecution().executedPlan().toString()
    assert name == "mended" and len([x for x in plan.splitlines() if "Exchange hashpartitioning" in x]) == 1
    assert sorted(r.value for r in recs.collect()) == ['1,"a\nb"', "2,c", "Code,Description"]
