"""Cross-facility indexes: by procedure code and by payer, with robust statistics, outlier flags and top-k lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions import expressions as X
from pricefold.functions.medians import exact_medians, exact_shares, true_median, upper_median
from pricefold.functions.payers import PAYER_RULES, Rules, canon_payer
from pricefold.sources.sinks import stored

CODE_TYPES = ["CPT", "HCPCS"]
#: Outliers: below the greater of these two, or above the multiple of the median.
LOW_FLOOR, LOW_SHARE, HIGH_TIMES = 50.0, 0.05, 25.0


def payer_stats(slim: DataFrame) -> DataFrame:
    """(ccn, raw_payer, n_items, n_rates, lowest, highest, median) over the shown payers of all items."""
    cells = slim.select("ccn", F.explode("top").alias("x")).select("ccn", F.col("x.p").alias("raw_payer"), F.col("x.r").alias("r"))
    return cells.groupBy("ccn", "raw_payer").agg(F.count("*").alias("n_items"), F.count_if(F.col("r") > 0).alias("n_rates"), F.min("r").alias("lowest"), F.max("r").alias("highest"), upper_median("r").alias("median"))


def with_canonical(stats: DataFrame, rules: Rules = PAYER_RULES) -> DataFrame:
    """Each row's canonical name, worked out from it alone: a join with the distinct names would need all statistics twice."""
    return stats.withColumn("c", canon_payer(F.col("raw_payer"), rules)).select("*", "c.*").drop("c")


def payer_rollup(stats: DataFrame) -> DataFrame:
    """For each canonical payer: facilities, items, up to ten aliases, the median of facility medians, the range."""
    aliases = F.slice(F.sort_array(F.collect_set(F.substring("raw_payer", 1, 60))), 1, 10)
    return stats.groupBy("slug", "display", "category").agg(F.count_distinct("ccn").alias("facilities"), F.sum("n_items").alias("n_items"), aliases.alias("aliases"), upper_median("median").alias("median"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))


def featured_payers(rollup: DataFrame, curated: list[str], least: int = 5, most: int = 200) -> DataFrame:
    """Curated payers, and those of ``least`` facilities or more; at most ``most``, by facilities."""
    return rollup.where(F.col("slug").isin(curated) | (F.col("facilities") >= least)).orderBy(F.desc("facilities"), "slug").limit(most)


def payer_facilities(stats: DataFrame, grades: DataFrame, k: int | None = 500) -> DataFrame:
    """The k facilities of each payer with the most items, with median rate and grade; all of them, without a rank, for None."""
    df = stats.groupBy("slug", "ccn").agg(F.sum("n_items").alias("n_items"), upper_median("median").alias("median"))
    if k is not None:
        df = df.withColumn("rank", F.row_number().over(Window.partitionBy("slug").orderBy(F.desc("n_items"), "ccn"))).where(F.col("rank") <= k)
    return df.join(grades.select("ccn", "grade"), "ccn", "left")


def code_entries(slim: DataFrame) -> DataFrame:
    """(code, ccn, prices, payer_max, payer_min): the price rows of indexed code types."""
    rates = F.transform("top", lambda x: x["r"])
    return slim.where(F.col("type").isin(CODE_TYPES)).select("code", "ccn", "desc", "gross", "cash", "min", "max", "pc", F.array_max(rates).alias("payer_max"), F.array_min(rates).alias("payer_min"), "bc", "s")


def code_coverage(entries: DataFrame) -> DataFrame:
    return entries.groupBy("code").agg(F.count("*").alias("n_entries"), F.count_distinct("ccn").alias("facilities"))


def ranked_codes(coverage: DataFrame, k: int = 5000) -> DataFrame:
    """The k codes with the most entries; equal ones by code."""
    return coverage.orderBy(F.desc("n_entries"), "code").limit(k)


def top_entries(entries: DataFrame, k: int = 25) -> DataFrame:
    """The k entries of each code: those with a gross charge first, higher ones first. Limited before anything is packed."""
    order = [F.col("gross").isNull(), F.desc("gross"), "ccn", F.col("bc"), F.col("s"), F.col("cash").asc_nulls_last()]
    return entries.withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy(*order))).where(F.col("rank") <= k)


def packed_entries(top: DataFrame) -> DataFrame:
    """One row for each code with its entries as an array, in order of rank."""
    fields = [c for c in top.columns if c not in ("code", "rank")]
    return top.groupBy("code").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("entries"))


def with_outliers(entries: DataFrame) -> DataFrame:
    """Entries with ``quality``: low, high, missing or normal, by the upper median of the code's cash prices. Nothing is dropped.

    Entries are written once, as medians and rows would each standardize all items anew."""
    entries = stored(entries, "entries")
    median = entries.groupBy("code").agg(upper_median("cash").alias("cash_median"))
    df = entries.join(median, "code")
    low = F.col("cash") < F.greatest(F.lit(LOW_FLOOR), LOW_SHARE * F.col("cash_median"))
    return df.withColumn("quality", X.choose([(F.col("cash").isNull(), "missing"), (low, "low"), (F.col("cash") > HIGH_TIMES * F.col("cash_median"), "high")], "normal"))


def procedure_stats(flagged: DataFrame) -> DataFrame:
    """For each code over normal rows: facilities, cash median and range, gross median; and how many were flagged."""
    normal = F.col("quality") == "normal"
    df = flagged.withColumns({"c": F.when(normal, F.col("cash")), "g": F.when(normal, F.col("gross")), "f": F.when(normal, F.col("ccn"))})
    return df.groupBy("code").agg(
        F.count_distinct("f").alias("facilities"), true_median("c").alias("cash_median"), F.min("c").alias("cash_min"), F.max("c").alias("cash_max"), true_median("g").alias("gross_median"),
        F.count_if(F.col("quality") == "low").alias("n_low"), F.count_if(F.col("quality") == "high").alias("n_high"),
    )


def procedure_rows(flagged: DataFrame, k: int = 500) -> DataFrame:
    """The k rows of each code: normal ones first, cheapest first, no price last."""
    order = [F.col("quality") != "normal", F.col("cash").asc_nulls_last(), "ccn", "bc", "s"]
    return flagged.withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy(*order))).where(F.col("rank") <= k)


def procedure_page(slim: DataFrame, facilities: DataFrame, k: int = 500) -> DataFrame:
    """The comparison page of every code: ranked facility rows with names, flags and the code's statistics."""
    flagged = with_outliers(code_entries(slim))
    rows = procedure_rows(flagged, k).select("code", "rank", "ccn", "gross", "cash", "payer_max", "quality", "bc", "s")
    stats = procedure_stats(flagged).select("code", "facilities", F.col("cash_median").alias("median_cash"), "n_low", "n_high")
    return rows.join(facilities.select("ccn", "name", "state"), "ccn", "left").join(stats, "code")


def code_ranges(entries: DataFrame) -> DataFrame:
    """Entries and the range of gross charges of each code."""
    return entries.groupBy("code").agg(F.count("*").alias("n_entries"), F.min("gross").alias("gross_min"), F.max("gross").alias("gross_max"))


def code_percentiles(entries: DataFrame, least: float = 10.0, shares: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """The robust spread of each code: gross charges above ``least`` at fixed shares of their ordered list."""
    priced = entries.where(F.col("gross") > least)
    return exact_shares(priced, ["code"], "gross", {f"p{round(100 * x)}": x for x in shares})


def hot_code_stats(entries: DataFrame) -> DataFrame:
    """(code, n, cash_median, gross_median, n_low, n_high): medians of all priced rows and the outliers by the cash median,
    with bounded state for each code; rows of a hot code stay spread over all tasks. The prices are written once and read five times."""
    entries = stored(entries.select("code", "cash", "gross"), "prices")
    cash = exact_medians(entries, ["code"], "cash").select("code", F.col("upper_median").alias("outlier_median"), F.col("true_median").alias("cash_median"))
    gross = exact_medians(entries, ["code"], "gross").select("code", F.col("true_median").alias("gross_median"))
    flagged = entries.select("code", "cash").join(cash, "code", "left").withColumn("low", F.col("cash") < F.greatest(F.lit(LOW_FLOOR), LOW_SHARE * F.col("outlier_median")))
    high = ~F.col("low") & (F.col("cash") > HIGH_TIMES * F.col("outlier_median"))
    out = flagged.groupBy("code").agg(F.count("*").alias("n"), F.first("cash_median").alias("cash_median"), F.count_if("low").alias("n_low"), F.count_if(high).alias("n_high"))
    return out.join(gross, "code", "left")


def spreads(entries: DataFrame) -> DataFrame:
    """Highest over lowest positive cash price of each code."""
    return entries.where("cash > 0").groupBy("code").agg((F.max("cash") / F.min("cash")).alias("spread"), F.count("*").alias("n")).where("n > 1")


def price_histogram(entries: DataFrame, bins: int = 32, least: int = 5) -> DataFrame:
    """(code, bin, n, is_median, n_low, n_high): cash prices of normal rows in logarithmic bins of equal width, for codes
    with ``least`` of them; the bin of their median, and how many rows lie in the outlier strip on either side.

    Bins begin at 1 at the least. One price alone is bin 0."""
    df = with_outliers(entries)
    normal = (F.col("quality") == "normal") & (F.col("cash") > 0)
    ends = df.withColumn("c", F.when(normal, F.col("cash"))).groupBy("code").agg(
        F.count("c").alias("k"), F.log10(F.greatest(F.lit(1.0), F.min("c"))).alias("a"), F.log10(F.max("c")).alias("b"), F.log10(true_median("c")).alias("m"),
        F.count_if(F.col("quality") == "low").alias("n_low"), F.count_if(F.col("quality") == "high").alias("n_high"),
    )
    place = lambda x: F.when(F.col("b") > F.col("a"), F.least(F.lit(bins - 1), F.floor((x - F.col("a")) * bins / (F.col("b") - F.col("a"))))).otherwise(0).cast("int")
    df = df.where(normal).join(ends.where(F.col("k") >= least), "code").withColumns({"bin": place(F.log10("cash")), "is_median": place(F.col("m"))})
    df = df.withColumn("is_median", F.col("bin") == F.col("is_median"))
    return df.groupBy("code", "bin", "is_median", "n_low", "n_high").agg(F.count("*").alias("n"))


def payer_totals(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count("*").alias("n_rows"), F.count_distinct("ccn").alias("facilities"), F.sum("n_rates").alias("n_rates"), F.count_distinct("raw_payer").alias("payers"))


def facility_pages(items: DataFrame, slim: DataFrame) -> DataFrame:
    """For each facility: codes, distinct payers shown, historical charges and the date of the newest one."""
    payers = slim.select("ccn", F.explode("top.p").alias("p")).groupBy("ccn").agg(F.count_distinct("p").alias("payers"))
    codes = slim.groupBy("ccn").agg(F.count_distinct("code").alias("codes"), F.count("*").alias("n_items"))
    dated = items.groupBy("ccn").agg(F.count_if("history").alias("n_history"), F.max("effective_date").alias("newest"))
    return codes.join(payers, "ccn", "left").join(dated, "ccn", "left").fillna(0)


def facility_index(slim: DataFrame, scores: DataFrame, facilities: DataFrame) -> DataFrame:
    """The price index: one row for each facility that has items, rebuilt from the items alone."""
    sums = slim.groupBy("ccn").agg(F.count("*").alias("n"), F.count_if(F.col("type").isin(CODE_TYPES)).alias("cpt_indexed"))
    return sums.join(scores.select("ccn", "score", "grade"), "ccn", "left").join(facilities.select("ccn", "name"), "ccn", "left")
