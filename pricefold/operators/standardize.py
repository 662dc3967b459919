"""From parsed items to standardized ones: filters, de-duplication, historical conflicts, top payers, compliance scores.

An item has ccn, seq, code, code_type, description, setting, billing_class, gross, cash, min_rate, max_rate, history
(whether gross comes from a dated column) and payers (array of struct payer, rate_dollar).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions import expressions as X

KEY = ["ccn", "code", "billing_class", "setting"]
# Points of each element of the compliance score.
WEIGHTS = {"mrf": 25, "gross": 15, "cash": 15, "payer_rates": 20, "min_max": 15, "free_access": 10}


def _counted(items: DataFrame) -> DataFrame:
    return items.withColumn("n_payers", F.coalesce(F.size("payers"), F.lit(0)))


def displayed(items: DataFrame) -> DataFrame:
    """Items with the code and type to show, ``n_payers``, and why an item is skipped (null: it isn't)."""
    df = _counted(items)
    priced = X.has_price(F.col("gross"), F.col("cash"), F.col("n_payers"))
    df = df.withColumn("shown", X.display_code_type(F.col("code"), F.col("code_type"), F.col("description"), priced))
    reason = X.choose([(F.col("shown.code") == "", "no code"), (~priced, "no price"), (~F.col("shown.type").isin(X.DISPLAY_TYPES), "type")])
    return df.withColumns({"code": F.col("shown.code"), "type": F.col("shown.type"), "skipped": reason}).drop("shown", "code_type")


def usable(items: DataFrame) -> DataFrame:
    """Items that :func:`displayed` doesn't skip.

    With a price, all that can be missing is a text to go by: so the filter asks for both before anything is worked out.
    A filter on the reason would be pushed below, with all that the reason is made of written out in it several times."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    df = _counted(items).where(X.has_price(F.col("gross"), F.col("cash"), F.col("n_payers"))).where(~(blank("code") & blank("description")))
    df = df.withColumn("shown", X.priced_code_type(F.col("code"), F.col("code_type"), F.col("description")))
    return df.withColumns({"code": F.col("shown.code"), "type": F.col("shown.type")}).drop("shown", "code_type")


def skipped_counts(items: DataFrame) -> DataFrame:
    """For each facility: items, items shown, and rejects by reason."""
    df = displayed(items)
    count = lambda reason: F.count_if(F.col("skipped") == reason)
    return df.groupBy("ccn").agg(F.count("*").alias("n_raw"), F.count_if(F.col("skipped").isNull()).alias("n_usable"), count("no code").alias("no_code"), count("no price").alias("no_price"), count("type").alias("other_type"))


def _preference() -> list[Column]:
    """More payers, then earlier in the file; rows alike in both are told apart by their content."""
    number = lambda c: F.coalesce(F.col(c), F.lit(-1.0)).desc()
    return [F.desc("n_payers"), F.asc("seq"), F.desc("description"), number("gross"), number("cash"), number("min_rate"), number("max_rate"), F.desc("history")]


def deduplicated(usable_items: DataFrame) -> DataFrame:
    """One item for each (facility, code, billing class, setting): most payers, then first, then least by content."""
    return usable_items.withColumn("__rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*_preference()))).where("__rank = 1").drop("__rank")


def conflicts(usable_items: DataFrame) -> DataFrame:
    """Keys with a historical charge among rows whose gross charges differ; no charge counts as a value of its own."""
    differ = F.coalesce(F.min("gross") != F.max("gross"), F.lit(False)) | F.count("gross").between(1, F.count("*") - 1)
    return usable_items.groupBy(*KEY).agg((F.bool_or("history") & differ).alias("conflict")).where("conflict").select(*KEY)


def without_conflicts(usable_items: DataFrame) -> DataFrame:
    """De-duplicated items whose key has no conflict: one shuffle and one sort.

    Keys repeat little, so partial aggregates would save little, and those of whole rows would be sorted anyway. One
    order serves ranks and conflicts, so that one operator works out both; the key's hash leads it, so that rows are told apart by a number."""
    w = Window.partitionBy("__hash", *KEY).orderBy(*_preference())
    over = lambda c: c.over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    differ = F.coalesce(over(F.min("gross")) != over(F.max("gross")), F.lit(False)) | over(F.count("gross")).between(1, over(F.count("*")) - 1)
    df = usable_items.withColumn("__hash", F.xxhash64(*KEY)).withColumns({"__rank": F.row_number().over(w), "__conflict": over(F.bool_or("history")) & differ})
    return df.where("__rank = 1 AND NOT __conflict").drop("__hash", "__rank", "__conflict")


def top_payers(payers: Column, k: int = 5) -> Column:
    """The k highest positive rates of an item, names cut to 40 characters; equal rates keep their order."""
    positive = F.transform(F.filter(payers, lambda x: x["rate_dollar"] > 0), lambda x, i: F.struct((-x["rate_dollar"]).alias("o"), i.alias("i"), F.substring(x["payer"], 1, 40).alias("p")))
    return F.transform(F.slice(F.sort_array(positive), 1, k), lambda x: F.struct(x["p"].alias("p"), (-x["o"]).alias("r")))


def slim(items: DataFrame) -> DataFrame:
    """Standardized items: shown codes, no duplicates, no conflicts, short texts, five payers."""
    df = without_conflicts(usable(items))
    return df.select("ccn", "code", "type", F.substring("description", 1, 100).alias("desc"), "gross", "cash", F.col("min_rate").alias("min"), F.col("max_rate").alias("max"), F.col("n_payers").alias("pc"), top_payers(F.col("payers")).alias("top"), F.substring("billing_class", 1, 16).alias("bc"), F.substring("setting", 1, 3).alias("s"))


def type_counts(slim_items: DataFrame) -> DataFrame:
    """(ccn, counts): a map from type to number of items."""
    by = slim_items.groupBy("ccn", "type").agg(F.count("*").alias("n"))
    return by.groupBy("ccn").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "n")))).alias("counts"))


def compliance(slim_items: DataFrame, facilities: DataFrame | None = None) -> DataFrame:
    """Score, grade and the elements' counts of each facility; facilities without items score nothing.

    Shares are compared as whole numbers, never as rounded ratios."""
    n = F.count("*")
    df = slim_items.groupBy("ccn").agg(n.alias("item_count"), F.count("gross").alias("n_gross"), F.count("cash").alias("n_cash"), F.count_if(F.col("pc") > 0).alias("n_payer"), F.count_if(F.col("min").isNotNull() & F.col("max").isNotNull()).alias("n_minmax"))
    if facilities is not None:
        df = facilities.select("ccn").join(df, "ccn", "left").fillna(0)
    share = lambda c, percent: 100 * F.col(c) >= percent * F.col("item_count")
    got = {"mrf": F.lit(True), "gross": share("n_gross", 80), "cash": share("n_cash", 50), "payer_rates": share("n_payer", 50), "min_max": share("n_minmax", 50), "free_access": F.lit(True)}
    score = reduce(lambda a, b: a + b, [F.when(got[k], w).otherwise(0) for k, w in WEIGHTS.items()])
    df = df.withColumn("score", F.when(F.col("item_count") == 0, 0).otherwise(score).cast("int"))
    return df.withColumn("grade", X.grade_for(F.col("score")))


def normalized_document(items: DataFrame) -> DataFrame:
    """Items in three levels: (ccn, item key, charges), where charges has an element for each distinct set of prices with its distinct payer facts.

    Nothing is merged that differs: a payer named twice under two rates keeps both."""
    item = ["ccn", "code", "code_type", "setting", "billing_class", "description"]
    prices = ["gross", "cash", "min_rate", "max_rate"]
    dealt = items.repartition(*item)  # both groupings find their rows together, so items travel once
    charges = dealt.groupBy(*item, *prices).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("payers")))).alias("payers"))
    return charges.groupBy(*item).agg(F.sort_array(F.collect_list(F.struct(*prices, "payers"))).alias("charges"))
