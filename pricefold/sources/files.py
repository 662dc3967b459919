"""Readers of price files and registries. Each gives items or rows with fixed columns, whatever the file's layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions.expressions import choose, normalize_code, to_money
from pricefold.sources import delimited
from pricefold.sources.layout import Layout, gross_charge, profile, resolve

RATES = "array<struct<payer:string,plan:string,rate_dollar:double>>"


def read_csv(spark: SparkSession, path: str, header_row: int = 0, delimiter: str = ",", file: str | None = None, row: str | None = None) -> DataFrame:
    """Delimited files as strings with their headers' names; in each file ``header_row`` records (blank ones too) come before its header.

    Each file has its own header: a column is picked by its name, and names that a file lacks are null in its rows. Quoted
    cells may have line breaks; blank lines are left out. ``file`` and ``row`` name columns to add: the path, and the number
    of the line on which the record begins, counted from the header."""
    lines = delimited.staged_lines(spark, path, delimiter)
    by_file = delimited._stored(delimited.by_file_of(lines), "files")
    recs = delimited.records(lines, by_file)
    heads = delimited._stored(delimited.headers(lines, recs, delimiter, header_row, by_file), "headers")
    layouts = heads.groupBy("layout").agg(F.min_by("header", "file").alias("header"), F.min("file").alias("first")).orderBy("first").collect()  # a row for each layout
    names = list(dict.fromkeys(n for r in layouts for n in r.header))
    rows = delimited.data_rows(recs, heads, delimiter).join(heads.select("file", "header", F.col("id").alias("header_id")), "file")
    if row:
        blocks = lines.groupBy("file", "block").agg(F.min("id").alias("start"), F.count("*").alias("many"))
        lines_before = F.sum("many").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        blocks = blocks.select("file", "block", "start", F.coalesce(lines_before, F.lit(0)).alias("lines_before"))
        top = blocks.where("block = 0").select("file", F.col("start").alias("top"))
        rows = rows.join(blocks, ["file", "block"]).join(top, "file")
    number = lambda: F.col("lines_before") + F.col("id") - F.col("start") - (F.col("header_id") - F.col("top")) - 1
    cell = lambda n: F.try_element_at("cells", F.nullif(F.array_position("header", F.lit(n)).cast("int"), F.lit(0)))
    more = ([F.col("file").alias(file)] if file else []) + ([number().alias(row)] if row else [])
    return rows.select(*[F.when(cell(n) != "", cell(n)).alias(n) for n in names], *more)


def ingest_files(spark: SparkSession, path: str, **how) -> DataFrame:
    """Items of delimited files of any layouts; see :func:`pricefold.sources.delimited.ingest_delimited`."""
    return delimited.ingest_delimited(spark, path, **how)


def resolve_file(df: DataFrame) -> Layout:
    return resolve(df.columns, profile(df))


def _place(row: str | None) -> Column:
    """A row's place: the column that says so, else the order of reading."""
    return F.col(f"`{row}`") if row else F.monotonically_increasing_id()


def _scalars(df: DataFrame, layout: Layout, row: str | None = None) -> DataFrame:
    gross, source = gross_charge(layout)
    coded = normalize_code(layout.get("code"), layout.get("code_type"))
    mnemonic = (layout.roles.get("code") or "").strip().lower() == "mnemonic"
    return df.select(
        "*", (F.struct(layout.get("code").alias("code"), F.lit("CDM").alias("code_type")) if mnemonic else coded).alias("__c"), layout.get("desc").alias("__desc"), layout.get("setting").alias("__setting"), layout.get("billing").alias("__billing"),
        gross.alias("__gross"), source.alias("__source"), to_money(layout.get("cash")).alias("__cash"), to_money(layout.get("min")).alias("__min"), to_money(layout.get("max")).alias("__max"), _place(row).alias("__seq"),
    )


_ITEM = [
    ("__c.code", "code"), ("__c.code_type", "code_type"), ("__desc", "description"), ("__setting", "setting"), ("__billing", "billing_class"), ("__gross", "gross"), ("__source", "gross_charge_source"), ("__cash", "cash"), ("__min", "min_rate"), ("__max", "max_rate"), ("__seq", "seq"),
]


def _named(source: str, target: str) -> Column:
    c = F.col(source)
    return (F.substring(c, 1, 300) if target == "description" else c).alias(target)


def ingest_tall(raw: DataFrame, layout: Layout | None = None, keys: Sequence[str] = (), row: str | None = None) -> DataFrame:
    """Items of tall files (a row for each code and payer): rows fold to (code, description), scalars come from the first row.

    ``keys`` are columns that tell files or facilities apart: items of different ones never merge. ``row`` is the place in the file."""
    layout = layout or resolve_file(raw.drop(*keys, *([row] if row else [])))
    df = _scalars(raw, layout, row)
    rate = to_money(F.col(f"`{layout.rate}`")) if layout.rate else F.lit(None).cast("double")
    payer, plan = F.substring(layout.get("payer"), 1, 100), F.substring(layout.get("plan"), 1, 100)
    cell = F.when((payer != "") & (rate > 0), F.struct("__seq", payer.alias("payer"), plan.alias("plan"), rate.alias("rate_dollar")))
    df = df.withColumn("__cell", cell)
    scalars = F.struct(*[_named(a, b) for a, b in _ITEM])
    out = df.groupBy(*keys, F.col("__c.code").alias("k1"), F.col("__desc").alias("k2")).agg(F.min_by(scalars, "__seq").alias("i"), F.sort_array(F.collect_list("__cell")).alias("cells"))
    return out.select(*keys, "i.*", F.transform("cells", lambda x: F.struct(x["payer"].alias("payer"), x["plan"].alias("plan"), x["rate_dollar"].alias("rate_dollar"))).cast(RATES).alias("payers"))


def ingest_wide(raw: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Items of a wide file (a column for each payer): positive cells become rates; a row needs a code, a gross charge or a rate."""
    layout = layout or resolve_file(raw)
    cells = [F.struct(F.lit(c[:100]).alias("payer"), F.lit(None).cast("string").alias("plan"), to_money(F.col(f"`{c}`")).alias("rate_dollar")) for c in layout.payers]
    rates = F.filter(F.array(*cells), lambda x: x["rate_dollar"] > 0) if cells else F.array()
    # the filter asks the raw cells: one on the items would be pushed below with all that they are made of written out in it
    coded, priced = layout.get("code") != "", gross_charge(layout)[0].isNotNull()
    raw = raw.where((coded | (layout.get("desc") != "")) & (coded | priced | (F.size(rates) > 0)))
    return _scalars(raw, layout).select(*[_named(a, b) for a, b in _ITEM], rates.cast(RATES).alias("payers"))


_DOCUMENT = """hospital_name string, last_updated_on string, version string, hospital_location string, hospital_address string,
license_information struct<license_number:string,state:string>,
standard_charge_information array<struct<description:string, code:string, code_type:string,
  code_information:array<struct<code:string,type:string,billing_code:string,code_type:string>>,
  standard_charges:array<struct<setting:string,billing_class:string,gross_charge:string,discounted_cash:string,minimum:string,maximum:string,
    payers_information:array<struct<payer_name:string,plan_name:string,payer:string,plan:string,standard_charge_dollar:string,standard_charge:string,methodology:string>>>>>>"""


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """JSON documents, one a file, or one a line; bad documents are skipped."""
    return spark.read.schema(_DOCUMENT).option("multiLine", multi_line).option("mode", "DROPMALFORMED").json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str = "hospital") -> DataFrame:
    """XML with the JSON form's field names."""
    return spark.read.schema(_DOCUMENT).option("rowTag", row_tag).xml(path)


def merged_headers(docs: DataFrame, key: str, order: str) -> DataFrame:
    """Documents that belong to one ``key`` with the header of the first of them (by ``order``) that has charges.

    Documents without charges are left out. Charges stay where they are: only headers travel, one for each key."""
    header = [c for c in docs.columns if c not in (key, order, "standard_charge_information")]
    full = docs.where(F.size("standard_charge_information") > 0)
    first = full.groupBy(key).agg(F.min_by(F.struct(*header), order).alias("__first"))
    return full.drop(*header).join(first, key).select(key, order, "__first.*", "standard_charge_information")


def ingest_documents(docs: DataFrame, order: str | None = None) -> DataFrame:
    """Items of documents: one for each standard charge; the code is the first of the entry. Header of each document is kept by name.

    ``order`` numbers the documents; several of one facility go through :func:`merged_headers` first."""
    entries = docs.select("hospital_name", _place(order).alias("doc"), F.posexplode_outer("standard_charge_information").alias("entry_at", "e"))
    charges = entries.select("*", F.posexplode("e.standard_charges").alias("charge_at", "sc"))
    first = F.try_element_at("e.code_information", F.lit(1))
    coded = normalize_code(F.coalesce(first["code"], first["billing_code"], F.col("e.code")), F.coalesce(first["type"], first["code_type"], F.col("e.code_type")))
    payers = F.transform(F.coalesce("sc.payers_information", F.array()), lambda p: F.struct(
        F.substring(F.coalesce(p["payer_name"], p["payer"], F.lit("")), 1, 100).alias("payer"), F.substring(F.coalesce(p["plan_name"], p["plan"], F.lit("")), 1, 100).alias("plan"),
        to_money(F.coalesce(p["standard_charge_dollar"], p["standard_charge"])).alias("rate_dollar"), F.substring(F.coalesce(p["methodology"], F.lit("")), 1, 80).alias("methodology"),
    ))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return charges.withColumn("c", coded).select(
        "hospital_name", F.col("c.code").alias("code"), F.col("c.code_type").alias("code_type"), F.substring(text("e.description"), 1, 300).alias("description"), text("sc.setting").alias("setting"), text("sc.billing_class").alias("billing_class"),
        to_money(F.col("sc.gross_charge")).alias("gross"), to_money(F.col("sc.discounted_cash")).alias("cash"), to_money(F.col("sc.minimum")).alias("min_rate"), to_money(F.col("sc.maximum")).alias("max_rate"), payers.alias("payers"), F.struct("doc", "entry_at", "charge_at").alias("seq"),
    )


# Keys of vendors' rows in the order that they count, and words that tell a payer's column.
VENDOR_CODES = ["code", "Code", "billing_code", "hcpcs", "HCPCS", "cpt", "CPT", "drg", "DRG", "NDC", "Charge Code"]
VENDOR_KEYS = {
    "minimum": ["minimum", "Minimum", "Min"], "maximum": ["maximum", "Maximum", "Max"], "payer": ["payer", "Payer", "payer_name", "Payer_Name"], "plan": ["plan", "Plan", "plan_name"],
    "rate": ["standard_charge_dollar", "standard_charge", "negotiated_rate", "payer_rate", "Rate"], "description": ["description", "Description", "service", "Service"], "setting": ["setting", "Setting"],
    "billing_class": ["billing_class", "Billing_Class"], "gross": ["gross_charge", "Gross_Charge", "Gross Charge"], "cash": ["cash_discount", "Cash_Discount", "Discounted Cash Price"],
}
VENDOR_PAYERS = "(?i)medicare|medicaid|aetna|anthem|blue|cigna|humana|united|health plan|ppo|hmo|advantage|commercial|molina"


def ingest_vendor_rows(rows: DataFrame, keys: Sequence[str] = (), row: str | None = None) -> DataFrame:
    """Items of vendors' JSON rows, given as a map from key to text (column ``row``): first present key counts.

    Rows fold to (keys, code, description). Without a rate, equal minimum and maximum are one; without a payer, keys that
    name payers are. ``keys`` and ``row`` as for tall files."""
    pick = lambda names: F.coalesce(*[F.when(F.trim(F.try_element_at("row", F.lit(k))) != "", F.trim(F.try_element_at("row", F.lit(k)))) for k in names])
    text = lambda role, most: F.coalesce(F.substring(pick(VENDOR_KEYS[role]), 1, most), F.lit(""))
    money = lambda role: to_money(pick(VENDOR_KEYS[role]))
    label = choose([(pick([k]).isNotNull(), F.lit(k)) for k in VENDOR_CODES], F.lit(""))
    df = rows.withColumn("seq", _place(row)).withColumn("c", normalize_code(pick(VENDOR_CODES), label))
    low, high, payer = money("minimum"), money("maximum"), text("payer", 100)
    rate = F.coalesce(money("rate"), F.when((low == high) & (payer != ""), low))
    cell = lambda who, plan, much: F.struct(F.col("seq").alias("seq"), who.alias("payer"), plan.alias("plan"), much.alias("rate_dollar"))
    named = F.map_filter("row", lambda k, v: k.rlike(VENDOR_PAYERS) & (to_money(v) > 0))
    from_keys = F.transform(F.map_entries(named), lambda e: cell(e["key"], F.lit(""), to_money(e["value"])))
    own = F.array(cell(payer, text("plan", 100), rate))
    cells = F.when((payer != "") & (rate > 0), own).when(payer == "", from_keys).otherwise(F.filter(own, lambda _: F.lit(False)))
    df = df.select(*keys, "seq", "c", *[text(x, 300).alias(x) for x in ("description", "setting", "billing_class")], money("gross").alias("gross"), money("cash").alias("cash"), low.alias("min_rate"), high.alias("max_rate"), cells.alias("cells"))
    scalars = F.struct(F.col("c.code").alias("code"), F.col("c.code_type").alias("code_type"), "description", "setting", "billing_class", "gross", "cash", "min_rate", "max_rate", "seq")
    out = df.groupBy(*keys, F.col("c.code").alias("k1"), F.col("description").alias("k2")).agg(F.min_by(scalars, "seq").alias("i"), F.sort_array(F.flatten(F.collect_list("cells"))).alias("cells"))
    return out.select(*keys, "i.*", F.transform("cells", lambda x: F.struct(x["payer"].alias("payer"), x["plan"].alias("plan"), x["rate_dollar"].alias("rate_dollar"))).cast(RATES).alias("payers"))


def sniff_format(content: Column, name: Column) -> Column:
    """Format of a file by its first bytes, else by its name."""
    head = F.hex(F.substring(content, 1, 4))
    # the cut may split a character, and files of other encodings aren't UTF-8: neither is an error
    text = F.regexp_replace(F.make_valid_utf8(F.substring(content, 1, 2048).cast("string")), r"^﻿?\s*", "")
    low = F.lower(text)
    by_name = choose([(F.lower(name).rlike(rf"\.{e}(\.gz)?([?#]|$)"), e) for e in ("csv", "json", "xml", "xlsx", "xls", "zip")], "unknown")
    return choose([
        (F.length(content) == 0, "empty"), (head.startswith("504B0304"), F.when(F.lower(name).contains(".xlsx"), "xlsx").otherwise("zip")), (head.startswith("1F8B"), "gzip"), (head == "D0CF11E0", "xls"), (head.startswith("25504446"), "pdf"),
        (low.rlike(r"^(<!doctype html|<html)"), "html"), (text.rlike(r"^[\[{]"), "json"), (low.startswith("<?xml") | text.rlike(r"^<[A-Za-z]"), "xml"), (F.element_at(F.split(text, "\n"), 1).rlike(r"[,|\t;].*[,|\t;]"), "csv"),
    ], by_name)


def read_corpus(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Parsed documents of a folder, plain or gzipped; of one facility's files the plain one counts; bad files are skipped."""
    df = spark.read.schema(f"ccn string, {schema}").option("mode", "DROPMALFORMED").option("multiLine", True).json(folder).withColumn("__path", F.col("_metadata.file_path"))
    rest = [c for c in df.columns if c not in ("ccn", "__path")]
    return df.where("ccn IS NOT NULL").groupBy("ccn").agg(F.min_by(F.struct(*rest), F.struct(F.col("__path").endswith(".gz"), F.col("__path"))).alias("d")).select("ccn", "d.*")


def load_registry(rows: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The last row of each ccn counts."""
    rest = [c for c in rows.columns if c not in ("ccn", ordinal)]
    return rows.groupBy("ccn").agg(F.max_by(F.struct(*rest), ordinal).alias("r")).select("ccn", "r.*")


def load_seeds(rows: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Rows without a ccn are skipped; the first row of each (ccn, URL) counts."""
    rest = [c for c in rows.columns if c not in ("ccn", "mrf_url", ordinal)]
    return rows.where(F.trim(F.coalesce("ccn", F.lit(""))) != "").groupBy("ccn", "mrf_url").agg(F.min_by(F.struct(*rest), ordinal).alias("r")).select("ccn", "mrf_url", "r.*")


def load_enforcement(spark: SparkSession, path: str) -> DataFrame:
    """Cases from CSV; dates become dates, so that they order by time."""
    return spark.read.option("header", True).csv(path).withColumn("date_of_action", F.coalesce(F.try_to_date("date_of_action", "M/d/yyyy"), F.try_to_date("date_of_action")))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and bad ones are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def declared_date(head: Column) -> Column:
    """The date that a file says it was last updated, from a JSON key or the CSV metadata rows; between 2019 and 2031."""
    key = F.regexp_extract(head, r'"(?:last_updated_on|last_updated|lastUpdatedOn)"\s*:\s*"([^"]+)"', 1)
    lines = F.filter(F.split(head, r"\r?\n"), lambda x: F.trim(x) != "")
    names = F.transform(F.split(F.try_element_at(lines, F.lit(1)), ","), lambda c: F.regexp_replace(F.lower(F.trim(F.replace(c, F.lit('"'), F.lit("")))), r"[ \-]", "_"))
    cell = F.try_element_at(F.split(F.try_element_at(lines, F.lit(2)), ","), F.array_position(names, "last_updated_on").cast("int"))
    text = F.trim(F.replace(F.when(key != "", key).otherwise(F.when(F.array_contains(names, "last_updated_on"), cell)), F.lit('"'), F.lit("")))
    day = F.coalesce(F.try_to_date(F.regexp_extract(text, r"^\d{4}-\d{2}-\d{2}", 0), "yyyy-MM-dd"), F.try_to_date(F.regexp_extract(text, r"^\d{1,2}/\d{1,2}/\d{4}", 0), "M/d/yyyy"))
    return F.when(F.year(day).between(2019, 2031), day)


def extract_header(docs: DataFrame) -> DataFrame:
    """Name, city, state, zip, license and version of submitted documents; the address may be an object or a text."""
    raw = F.coalesce("hospital_address", "hospital_location", F.lit(""))
    part = lambda k: F.get_json_object(raw, f"$.{k}")
    found = lambda i: F.regexp_extract(raw, r"([A-Za-z .'-]+),\s*([A-Z]{2})\s+(\d{5})(?:-\d{4})?", i)
    either = lambda k, i: F.coalesce(part(k), F.when(found(i) != "", F.trim(found(i))))
    return docs.select("hospital_name", either("city", 1).alias("city"), either("state", 2).alias("state"), either("zip", 3).alias("zip"), F.col("license_information.license_number").alias("license"), F.col("license_information.state").alias("license_state"), "version", "last_updated_on")
