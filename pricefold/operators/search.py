"""The query surface: searches, pages, rankings and filters, all plain functions of frames and parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions import expressions as X
from pricefold.operators.indexes import code_ranges


def page(df: DataFrame, order: list, limit: int = 50, offset: int = 0, most: int = 200) -> DataFrame:
    """One page of an order; limit and offset are clamped."""
    return df.orderBy(*order).offset(max(0, offset)).limit(max(1, min(limit, most)))


def search_facilities(registry: DataFrame, text: str, state: str | None = None, limit: int = 25) -> DataFrame:
    """Scored by id, name and city; ties by name, then id."""
    t = text.strip().lower()
    name, city, ccn = F.lower("name"), F.lower("city"), F.lower("ccn")
    score = X.choose([(ccn == t, 100), (name.startswith(t), 80), (ccn.startswith(t), 70), (name.contains(t), 60), (city.startswith(t), 40), (city.contains(t), 30)], 0)
    df = registry.where(F.col("state") == state) if state else registry
    return df.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), "name", "ccn").limit(limit)


def search_procedures(entries: DataFrame, texts: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """Codes by exact code, prefix or description, with coverage and gross range."""
    q = query.strip()
    df = code_ranges(entries).join(texts, "code", "left")
    score = X.choose([(F.col("code") == q.upper(), 100), (F.col("code").startswith(q.upper()), 80), (F.lower("text").contains(q.lower()), 50)], 0)
    return df.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), F.desc("n_entries"), "code").limit(limit)


def procedure_prices(entries: DataFrame, facilities: DataFrame, code: str, limit: int = 50, offset: int = 0) -> DataFrame:
    """The facilities' rows of one code by gross charge, no charge last, each with the number of all rows as ``total``.

    A page beyond the end is one row with the total alone."""
    df = entries.where(F.col("code") == code.strip().upper())
    rows = page(df.join(facilities.select("ccn", "name", "state"), "ccn", "left"), [F.col("gross").asc_nulls_last(), "ccn", "bc", "s"], limit, offset)
    total = df.agg(F.count("*").alias("total"))  # one row
    return total.join(rows, F.lit(True), "left").orderBy(F.col("gross").asc_nulls_last(), "ccn", "bc", "s")


def facility_items(slim: DataFrame, ccn: str, limit: int = 50, offset: int = 0) -> DataFrame:
    """One facility's items by gross charge, highest first, none as zero."""
    return page(slim.where(F.col("ccn") == ccn), [F.desc(F.coalesce("gross", F.lit(0.0))), "code", "bc", "s"], limit, offset)


def search_payers(rollup: DataFrame, text: str, limit: int = 25) -> DataFrame:
    t = text.strip().lower()
    name = F.lower("display")
    score = X.choose([((name == t) | (F.col("slug") == t), 100), (name.startswith(t) | F.col("slug").startswith(t), 80), (name.contains(t) | F.col("slug").contains(t), 60)], 0)
    return rollup.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), F.desc("facilities"), "slug").limit(limit)


def similar_payers(rollup: DataFrame, slug: str, k: int = 5) -> DataFrame:
    """Slugs that contain the wanted one or are contained in it, for a payer that isn't there."""
    return rollup.where(F.col("slug").contains(slug) | F.lit(slug).contains(F.col("slug"))).orderBy(F.desc("facilities"), "slug").limit(k)


def compliance_ranking(scores: DataFrame, facilities: DataFrame) -> DataFrame:
    """Facilities by score, then items, with their place.

    Places add up: rows of higher scores (as many sums as there are scores, at most 101), rows of the score with more
    items, and the place among equals; no task sees all rows."""
    df = scores.join(facilities.select("ccn", "name", "state"), "ccn", "left")
    sizes = scores.groupBy("score", "item_count").agg(F.count("*").alias("k"))
    whole = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    higher = sizes.groupBy("score").agg(F.sum("k").alias("k")).select("score", F.coalesce(F.sum("k").over(whole), F.lit(0)).alias("a"))
    more = sizes.select("score", "item_count", F.coalesce(F.sum("k").over(Window.partitionBy("score").orderBy(F.desc("item_count")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    df = df.join(more, ["score", "item_count"]).join(higher, "score")
    rank = F.row_number().over(Window.partitionBy("score", "item_count").orderBy("ccn"))
    return df.withColumn("place", (F.col("a") + F.col("b") + rank).cast("int")).drop("a", "b").orderBy(F.desc("score"), F.desc("item_count"), "ccn")


def grade_distribution(scores: DataFrame) -> DataFrame:
    return scores.groupBy("grade").agg(F.count("*").alias("n"))


def search_codes(coverage: DataFrame, prefix: str = "", by_code: bool = False, limit: int = 20) -> DataFrame:
    df = coverage.where(F.col("code").startswith(prefix.upper()))
    return df.orderBy("code").limit(limit) if by_code else df.orderBy(F.desc("n_entries"), "code").limit(limit)


def directory(facts: DataFrame, text: str = "", state: str | None = None, status: str | None = None) -> DataFrame:
    """The facility list by text, state and status (compliant, missing, enforcement, missing-enforcement), grouped by state."""
    t = text.strip().lower()
    missing = F.col("required") & ~F.col("has_live")
    tests: dict[str | None, Column] = {None: F.lit(True), "compliant": F.col("required") & F.col("has_live"), "missing": missing, "enforcement": F.col("cases") > 0, "missing-enforcement": missing & (F.col("cases") > 0)}
    df = facts.where(tests[status] & (F.lower("name").contains(t) | F.lower("city").contains(t) | F.lower("ccn").contains(t)))
    df = df.where(F.col("state") == state) if state else df
    return df.withColumn("state", F.coalesce(X.blank_to_null(F.col("state")), F.lit("UNKNOWN"))).orderBy("state", "name", "ccn")


def procedure_filter(rows: DataFrame, state: str | None = None, payer: str | None = None) -> DataFrame:
    """Rows of a state and with a payer, by slug or by part of the name."""
    df = rows.where(F.col("state") == state) if state else rows
    if payer:
        df = df.where(F.exists("top", lambda x: (X.slugify(x["p"]) == payer) | F.lower(x["p"]).contains(payer.lower())))
    return df


def _procedure_orders(by: str) -> list[Column]:
    return {
        "typical": [F.col("quality") != "normal", F.abs(F.col("cash") - F.col("median_cash")).asc_nulls_last()], "state": [F.col("state").asc_nulls_last(), F.col("name").asc_nulls_last()],
        "cash": [F.col("cash").asc_nulls_last()], "cash desc": [F.col("cash").desc_nulls_last()], "gross": [F.col("gross").asc_nulls_last()], "payer": [F.col("payer_min").asc_nulls_last()],
    }[by] + [F.col(c) for c in ("ccn", "bc", "s")]


def ordered_procedure(rows: DataFrame, by: str = "typical") -> DataFrame:
    """The orders of a comparison page; no value comes last in all of them. Payers: by the lowest of a row's rates."""
    return rows.orderBy("code", *_procedure_orders(by))


def first_of_procedures(rows: DataFrame, by: str = "typical", k: int = 10) -> DataFrame:
    """The first ``k`` rows of each code's page in an order, with their place.

    Spark keeps ``k`` rows of a code in each task before the shuffle, so a hot code sends few rows."""
    place = F.row_number().over(Window.partitionBy("code").orderBy(*_procedure_orders(by)))
    return rows.withColumn("place", place).where(F.col("place") <= k)


def ordered_payer_page(rows: DataFrame, by: str = "items") -> DataFrame:
    orders = {"items": [F.desc("n_items")], "median": [F.col("median").asc_nulls_last()], "grade": [X.grade_rank(F.col("grade")).asc_nulls_last()], "state": [F.col("state").asc_nulls_last()]}
    return rows.orderBy("slug", *orders[by], "ccn")


def resolve_name(texts: DataFrame, coverage: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """Codes that a user's words mean: the code itself if it has a code's shape, else descriptions that contain them."""
    q = query.strip()
    df = texts.where(F.when(F.lit(q.upper()).rlike("^[A-Z0-9]{5}$"), F.col("code") == q.upper()).otherwise(F.lower("text").contains(q.lower())))
    return df.join(coverage.select("code", "n_entries"), "code").orderBy(F.desc("n_entries"), "code").limit(limit)


def valid_ids(df: DataFrame) -> DataFrame:
    """Whether ccn, code and slug have the shape of one."""
    return df.select("*", F.col("ccn").rlike("^[0-9A-Z]{6}$").alias("ccn_ok"), F.col("code").rlike("^[A-Za-z0-9.-]{1,16}$").alias("code_ok"), F.col("slug").rlike("^[a-z0-9][a-z0-9-]{0,79}$").alias("slug_ok"))


def without_hosts(urls: DataFrame, blocked: list[str]) -> DataFrame:
    """URLs of hosts that aren't blocked, nor below a blocked one."""
    host = X.url_host(F.col("url"))
    return urls.where(~X.any_of((host == b) | host.endswith("." + b) for b in blocked))
