"""Delimited files of many layouts in one plan: lines, records, headers, column roles and items, all as tables.

Files are read line by line, so a large file is read by as many tasks as it has blocks. A line's place is (block, id): the
start of its block in the file, and a number that grows within the block. Nothing is planned file by file: headers are rows
of a table, a layout's roles are positions in it, and a row's cells are picked from its array of cells by its file's roles.

Line breaks within quoted cells are put right only in files that have them. What a line does to the state "within quotes"
is a function of that state: it keeps it, flips it, or sets it. Such functions are composed within blocks and then over the
blocks of a file, so no file has to pass one task. A quoted cell of more than ``MOST_LINES`` lines counts as a stray quote,
and its lines as records of their own."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions.expressions import header_fingerprint, is_money, keyword_match, norm_header, normalize_code, to_money
from pricefold.sources import layout as L
from pricefold.sources.sinks import scratch_path

MOST_LINES = 10_000
#: Lines of a file that are looked at for its header, and records among them.
HEAD_LINES, HEAD_RECORDS = 200, 30
PLACE = ("block", "id")
RATES = "array<struct<payer:string,plan:string,rate_dollar:double>>"


# ---- lines and records ---------------------------------------------------------------------------------------------


def _stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quote_steps(value: Column, delimiter: str) -> tuple[Column, Column]:
    """Whether a line ends within quotes if it begins outside of them, and if it begins within. Quotes inside a bare cell don't count."""
    d = re.escape(delimiter)
    rest = r'[^"]*+(?:""[^"]*+)*+'
    open_end = rf'(?:(?:"{rest}"[^{d}]*+|(?!")[^{d}]*+){d})*+"{rest}$'
    quoted = value.contains('"')
    one = F.length(F.replace(value, F.lit('"'), F.lit(""))) == F.length(value) - 1  # it opens a cell or closes one
    opens = value.startswith('"') | value.contains(f'{delimiter}"')
    return F.when(~quoted, False).when(one, opens).otherwise(value.rlike(f"^{open_end}")), F.when(~quoted, True).when(one, False).otherwise(value.rlike(rf'^{rest}(?:$|"[^{d}]*+{d}{open_end})'))


def staged_lines(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """file, block, id, value, the two quote steps of each line, and whether its file is one block, written once: the texts themselves are read once."""
    value = F.when(F.col("value").startswith("﻿"), F.substring("value", 2, 1 << 30)).otherwise(F.col("value"))
    whole = F.col("_metadata.file_block_length") == F.col("_metadata.file_size")
    df = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), value.alias("value"), whole.alias("whole"))
    outside, inside = quote_steps(F.col("value"), delimiter)
    return _stored(df.withColumns({"from_outside": outside, "from_inside": inside}), "lines", **{"parquet.enable.dictionary#value": "false"})  # most lines differ


def by_file_of(lines: DataFrame, *more: str) -> DataFrame:
    """A row for each file: its first line's id, whether lines break within quotes, and whether it has several blocks."""
    return lines.groupBy("file", *more).agg(F.min(F.when(F.col("block") == 0, F.col("id"))).alias("first"), F.max("from_outside").alias("breaks"), F.max(~F.col("whole")).alias("several"))


def numbered(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines with a number of 64 bits in place of their file's path, and a row for each file with its ``path``.

    Paths are longer than most lines, and begin alike: as numbers they are cheap to send, to sort and to look up. Another
    seed is taken if two paths should have one number."""
    for seed in itertools.count():
        of = lines.withColumnRenamed("file", "path").withColumn("file", F.xxhash64("path", F.lit(seed)))
        by_file = _stored(by_file_of(of, "path"), "files")
        if by_file.groupBy("file").count().where("count > 1").isEmpty():
            return of.drop("path"), by_file


def _composed(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds what the steps up to each row make of a state: whether it ``flips``, unless it is ``fixed``, and then to what. ``before``
    has the same for the steps before the row."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    past = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    df = df.withColumn("n_flips", F.sum(flip).over(upto))
    flips, flipped = F.col("n_flips") % 2 == 1, (F.col("n_flips") - flip) % 2 == 1
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside") != flips)  # turned back by the flips up to there
    df = df.withColumns({"fixed": F.last(fixed, ignorenulls=True).over(upto) != flips, "fixed_before": F.last(fixed, ignorenulls=True).over(past) != flipped})
    return df.withColumns({"flips": flips, "before": F.struct(flipped.alias("flips"), F.col("fixed_before").alias("fixed"))}).drop("n_flips", "fixed_before")


def _after(start: Column, steps: str = "") -> Column:
    """The state after composed steps that begin with ``start``."""
    return F.coalesce(F.col(f"{steps}fixed"), start != F.col(f"{steps}flips"))


def _begins(inner: DataFrame, start: Column) -> DataFrame:
    """For composed lines of blocks that begin with ``start``: the id of the line in its block on which its record begins (``own``),
    null for a record of an earlier block."""
    upto = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return inner.withColumn("own", F.last(F.when(~_after(start, "before."), F.col("id")), ignorenulls=True).over(upto))


def _joined(told: DataFrame, *begin: str) -> DataFrame:
    """Records of lines that know the place on which theirs begins; one of more than ``MOST_LINES`` lines falls into its lines."""
    many = F.count("*").over(Window.partitionBy("file", *begin))
    told = told.withColumn("stray", many > MOST_LINES)
    told = told.select("file", *PLACE, "value", *[F.when(F.col("stray"), F.col(p)).otherwise(F.col(b)).alias(f"at_{p}") for p, b in zip(PLACE, begin)])
    # its lines from each one on: few, and only the first one's are kept
    rest = Window.partitionBy("file", *[f"at_{p}" for p in PLACE]).orderBy(*PLACE).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    told = told.withColumn("texts", F.collect_list("value").over(rest)).where("block = at_block AND id = at_id")
    return told.select("file", *PLACE, F.array_join("texts", "\n").alias("value"))


def records(lines: DataFrame, by_file: DataFrame | None = None) -> DataFrame:
    """file, block, id and value of each record: a line, or several where a quoted cell has line breaks. The place is the first line's.

    Files with such cells are put right once and written; the others' lines are records as they are. What a file of one block
    needs is in that block, so its lines are dealt out and sorted once."""
    by_file = _stored(by_file_of(lines), "files") if by_file is None else by_file  # its size is known to what joins it
    plain = lines.join(by_file.where("NOT breaks").select("file"), "file", "left_semi").select("file", *PLACE, "value")
    broken = lines.join(by_file.where("breaks").select("file"), "file", "left_semi")
    composed = lambda df: _composed(df, ["file", "block"], "id")
    mended = _joined(_begins(composed(broken.where("whole")), F.lit(False)), "block", "own")
    if not by_file.where("breaks AND several").isEmpty():
        mended = mended.unionByName(_over_blocks(composed(broken.where("NOT whole"))))
    return plain.unionByName(_stored(mended, "mended"))


def _over_blocks(inner: DataFrame) -> DataFrame:
    """Records of files of several blocks: the state in which a block begins comes from all blocks before it."""
    inner = _stored(inner.select("file", *PLACE, "value", "flips", "fixed", "before"), "composed")
    by_file = Window.partitionBy("file").orderBy("block")
    blocks = inner.groupBy("file", "block").agg(F.max_by(F.struct("flips", "fixed"), "id").alias("s")).select("file", "block", "s.*")
    blocks = _composed(blocks.select("file", "block", _after(F.lit(False)).alias("from_outside"), _after(F.lit(True)).alias("from_inside")), ["file"], "block")
    starts = blocks.select("file", "block", F.lag(_after(F.lit(False)), 1, False).over(by_file).alias("start"))
    told = _stored(_begins(inner.join(_stored(starts, "starts"), ["file", "block"]), F.col("start")).select("file", *PLACE, "value", "own"), "told")
    # a record that began in a block before this one: the last one that began in any of them
    last = told.groupBy("file", "block").agg(F.max("own").alias("own")).select("file", "block", F.when(F.col("own").isNotNull(), F.struct("block", "own")).alias("last"))
    carried = last.select("file", "block", F.last("last", ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    told = told.join(_stored(carried, "carried"), ["file", "block"])
    return _joined(told.select("file", *PLACE, "value", F.when(F.col("own").isNotNull(), F.col("block")).otherwise(F.col("carried.block")).alias("in"), F.coalesce("own", "carried.own").alias("own")), "in", "own")


def split_cells(value: Column, delimiter: str = ",") -> Column:
    """A record's cells; quotes around a cell are taken off, doubled ones inside count once."""
    d = re.escape(delimiter)
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), value), F.lit(rf'{d}(?:"[^"]*+(?:""[^"]*+)*+"[^{d}]*+|[^{d}]*+)'), F.lit(0))
    bare = F.transform(found, lambda c: F.substring(c, 2, 1 << 30))
    quoted = F.transform(bare, lambda c: F.when(c.startswith('"'), F.replace(F.regexp_replace(c, '^"([^"]*+(?:""[^"]*+)*+)"', "$1"), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(value.contains('"'), quoted).otherwise(F.split(value, d, -1))


# ---- headers and layouts -------------------------------------------------------------------------------------------

# The groups of words of which a header row has some.
SIGNALS = [L.CODE_HINTS, L.DESC_HINTS, L.GROSS_HINTS, L.CASH_HINTS, L.PAYER_HINTS, L.PLAN_HINTS, L.RATE_HINTS, ["price", "charge", "standard_charge"]]
TALL_NAMES = ("payer", "payer_name")


def headers(lines: DataFrame, recs: DataFrame, delimiter: str = ",", header_row: int | None = None, by_file: DataFrame | None = None) -> DataFrame:
    """file, header (its cells), layout and the header's place: the record of that number, blank ones counted too, or else the
    first of those with most signals (two at least) and then most cells, or else the first one."""
    by_file = _stored(by_file_of(lines), "files") if by_file is None else by_file
    most = max(HEAD_RECORDS, (header_row or 0) + 1)
    near = F.when(F.col("breaks"), HEAD_LINES).otherwise(min(HEAD_LINES, most))  # lines of other files are records
    head = recs.where("block = 0").join(by_file.select("file", "first", "breaks"), "file").where(F.col("id") < F.col("first") + near)
    texts = head.groupBy("file").agg(F.slice(F.sort_array(F.collect_list(F.struct("id", "value"))), 1, most).alias("rows"))  # HEAD_LINES at most
    cells = lambda value: F.transform(split_cells(value, delimiter), lambda c: F.trim(c))
    found = lambda h: [h["id"].alias("id"), h["cells"].alias("header"), header_fingerprint(h["cells"]).alias("layout")]
    if header_row is not None:
        own = texts.select("file", F.try_element_at("rows", F.lit(header_row + 1)).alias("r")).where("r IS NOT NULL")
        return own.select("file", F.struct("r.id", cells(F.col("r.value")).alias("cells")).alias("h")).select("file", *found(F.col("h")))
    rows = texts.select("file", F.transform("rows", lambda r: F.struct(r["id"].alias("id"), cells(r["value"]).alias("cells"))).alias("rows"))
    # one text of a row's names for each row: no word has the line break that parts them
    names = rows.select("file", "rows", F.transform("rows", lambda r: F.struct(r["id"].alias("id"), r["cells"].alias("cells"), F.regexp_replace(F.lower(F.array_join(r["cells"], "\n")), r"[ \-]", "_").alias("names"))).alias("named"))
    signals = lambda names: sum((names.rlike("|".join(re.escape(w.replace(" ", "_")) for w in words)).cast("int") for words in SIGNALS), F.lit(0))
    filled = lambda cs: F.size(F.filter(cs, lambda c: c != ""))
    scored = names.select("file", "rows", F.transform("named", lambda r: F.struct(signals(r["names"]).alias("signals"), filled(r["cells"]).alias("filled"), (-r["id"]).alias("early"), r["cells"].alias("cells"))).alias("scored"))
    best = scored.select("file", "rows", F.array_max(F.filter("scored", lambda r: (r["filled"] >= 2) & (r["signals"] >= 2))).alias("best"))
    chosen = F.when(F.col("best").isNotNull(), F.struct((-F.col("best.early")).alias("id"), F.col("best.cells").alias("cells"))).otherwise(F.col("rows")[0])
    return best.select("file", chosen.alias("h")).select("file", *found(F.col("h")))


def data_rows(recs: DataFrame, heads: DataFrame, delimiter: str = ",") -> DataFrame:
    """file, block, id and cells of the records below each file's header; blank ones are left out."""
    below = recs.join(heads.select("file", F.col("id").alias("header_id")), "file").where((F.col("block") > 0) | (F.col("id") > F.col("header_id")))
    return below.where(F.trim("value") != "").select("file", *PLACE, split_cells(F.col("value"), delimiter).alias("cells"))


def column_profiles(rows: DataFrame) -> DataFrame:
    """file and, by position, the share of rows with a value and the share of those that are prices (struct array ``profile``)."""
    cells = rows.select("file", F.posexplode("cells").alias("at", "cell"))
    text = F.trim("cell")
    of = cells.groupBy("file", "at").agg(F.count_if(text != "").alias("filled"), F.count_if((text != "") & is_money(F.col("cell"))).alias("prices"), F.count("*").alias("many"))
    one = F.sort_array(F.collect_list(F.struct("at", "filled", F.coalesce(F.try_divide("prices", "filled"), F.lit(0.0)).alias("prices"))))
    df = of.groupBy("file").agg(one.alias("profile"), F.max("many").alias("many"))  # every row has a first cell: the file's rows aren't counted anew
    return df.select("file", F.transform("profile", lambda x: F.struct(x["at"].alias("at"), (x["filled"] / F.col("many")).alias("filled"), x["prices"].alias("prices"))).alias("profile"))


ROLES = ("code", "code_type", "desc", "gross", "cash", "min", "max", "setting", "billing", "payer", "plan")
RESOLVED = f"layout string, tall boolean, mnemonic boolean, roles struct<{', '.join(f'`{r}`:int' for r in ROLES)}>, rate int, payers array<struct<at:int,name:string>>, dated array<struct<at:int,header:string,day:date>>, notes array<string>"


def resolved_layouts(heads: DataFrame, profiles: DataFrame, learned: DataFrame | None = None) -> DataFrame:
    """A row for each file: its roles as positions in its rows. ``learned`` has layout and roles (map from role to header).

    The rules for one header are those of :func:`pricefold.sources.layout.resolve`; files are dealt out by Spark."""
    df = heads.select("file", "layout", "header").join(profiles, "file", "left")
    df = df.join(learned.select("layout", F.col("roles").alias("known")), "layout", "left") if learned is not None else df.withColumn("known", F.lit(None).cast("map<string,string>"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                names = list(r.header)
                shares = {x["at"]: (x["filled"], x["prices"]) for x in (r.profile if r.profile is not None else [])}
                profiled = {n: shares.get(i, (0.0, 0.0)) for i, n in reversed(list(enumerate(names)))}
                known = dict(r.known) if r.known is not None else None
                found = L.resolve(names, profiled, {L.layout_id(names): known} if known else None)
                at = lambda h: names.index(h) if h in names else None  # noqa: B023, E731
                tall = any(L.normal(n) in TALL_NAMES or "negotiated_rate" in L.normal(n) for n in names)
                mnemonic = L.normal(found.roles.get("code") or "") == "mnemonic"
                gross_dated = found.roles.get("gross") in {h for _, h in found.dated}
                dated = [{"at": at(h), "header": h, "day": day} for day, h in found.dated] if gross_dated else []
                out.append((r.file, r.layout, tall, mnemonic, {k: at(found.roles.get(k)) for k in ROLES}, at(found.rate), [{"at": at(h), "name": h} for h in found.payers], dated, found.notes))
            yield pd.DataFrame(out, columns=["file", "layout", "tall", "mnemonic", "roles", "rate", "payers", "dated", "notes"]).astype({"rate": "Int32"})

    # dealt by a fixed number: a row is small, but its rules take time, and few bytes would be put into one task
    dealt = df.select("file", "layout", "header", "profile", "known").repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInPandas(work, f"file {heads.schema['file'].dataType.simpleString()}, {RESOLVED}")


# ---- items ---------------------------------------------------------------------------------------------------------


def ingest_delimited(spark: SparkSession, path: str, delimiter: str = ",", header_row: int | None = None, learned: DataFrame | None = None) -> DataFrame:
    """Items of all files below ``path``, whatever each one's layout, tall or wide; ``file`` and the first row's place tell them apart.

    Rows of a tall file fold to (code, description), with scalars of the first; a wide file's rows stay items of their own,
    if they have a code or description and a code, a gross charge or a rate."""
    lines, by_file = numbered(staged_lines(spark, path, delimiter))
    recs = records(lines, by_file)
    heads = _stored(headers(lines, recs, delimiter, header_row, by_file), "headers")
    rows = _stored(data_rows(recs, heads, delimiter), "rows")  # split once, for profiles and for items
    layouts = _stored(resolved_layouts(heads, column_profiles(rows), learned), "layouts")
    items = items_of(rows, layouts)
    return items.join(by_file.select("file", "path"), "file").select(F.col("path").alias("file"), *[c for c in items.columns if c != "file"])


def items_of(rows: DataFrame, layouts: DataFrame) -> DataFrame:
    """Items of rows by their files' resolved layouts. Scalars are worked out once an item: folding takes codes and rates, and keeps the first row's cells."""
    layouts, place = layouts.drop("notes"), F.struct(*PLACE).alias("place")
    cell = lambda at: F.trim(F.coalesce(F.try_element_at("cells", at + 1), F.lit("")))
    role = lambda name: F.when(F.col(f"roles.{name}").isNotNull(), cell(F.col(f"roles.{name}"))).otherwise("")
    cut = lambda c, n: F.substring(c, 1, n)
    dated = F.filter(F.transform("dated", lambda d: F.struct(to_money(cell(d["at"])).alias("amount"), F.struct(d["header"].alias("header"), d["day"].alias("effective_date")).alias("source"))), lambda x: x["amount"] >= 0)
    newest, is_dated = F.try_element_at(dated, F.lit(1)), F.size("dated") > 0
    gross = F.when(is_dated, newest["amount"]).otherwise(to_money(role("gross")))
    coded = normalize_code(role("code"), role("code_type"))
    code, code_type = F.when(F.col("mnemonic"), role("code")).otherwise(coded["code"]), F.when(F.col("mnemonic"), "CDM").otherwise(coded["code_type"])
    scalars = [code.alias("code"), code_type.alias("code_type"), cut(role("desc"), 300).alias("description"), role("setting").alias("setting"), role("billing").alias("billing_class"), gross.alias("gross"), F.when(is_dated, newest["source"]).alias("gross_charge_source"), *[to_money(role(x)).alias(y) for x, y in (("cash", "cash"), ("min", "min_rate"), ("max", "max_rate"))]]
    of_all = lambda df: df.select("file", "layout", *scalars, "place", F.col("payers").cast(RATES).alias("payers"))

    tall = rows.join(layouts.where("tall"), "file")
    tall = tall.select("file", place, "cells", code.alias("k1"), role("desc").alias("k2"), cut(role("payer"), 100).alias("payer"), cut(role("plan"), 100).alias("plan"), to_money(F.when(F.col("rate").isNotNull(), cell(F.col("rate")))).alias("rate_dollar"))
    rate = F.when((F.col("payer") != "") & (F.col("rate_dollar") > 0), F.struct("place", "payer", "plan", "rate_dollar"))
    folded = tall.groupBy("file", "k1", "k2").agg(F.min(F.struct("place", "cells")).alias("first"), F.sort_array(F.collect_list(rate)).alias("rates"))
    folded = folded.select("file", "first.*", F.transform("rates", lambda x: F.struct(x["payer"].alias("payer"), x["plan"].alias("plan"), x["rate_dollar"].alias("rate_dollar"))).alias("payers"))

    wide = rows.join(layouts.where("NOT tall"), "file").withColumnRenamed("payers", "columns")
    rates = F.filter(F.transform("columns", lambda p: F.struct(cut(p["name"], 100).alias("payer"), F.lit(None).cast("string").alias("plan"), to_money(cell(p["at"])).alias("rate_dollar"))), lambda x: x["rate_dollar"] > 0)
    given = role("code") != ""  # the filter asks the cells: a code that is given is not blank in its normal form either
    wide = wide.where((given | (role("desc") != "")) & (given | gross.isNotNull() | (F.size(rates) > 0)))
    return of_all(folded.join(layouts.drop("payers"), "file")).unionByName(of_all(wide.select("*", place, rates.alias("payers"))))
