"""Facilities, their sources and the regulator's cases: best sources, coverage, gaps and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.functions import expressions as X
from pricefold.functions.medians import upper_median


def latest_probes(probes: DataFrame) -> DataFrame:
    """The last probe of each (facility, URL); equal times go by event."""
    rest = [c for c in probes.columns if c not in ("ccn", "mrf_url")]
    return probes.groupBy("ccn", "mrf_url").agg(F.max_by(F.struct(*rest), F.struct("probed_at", "event_id")).alias("p")).select("ccn", "mrf_url", "p.*")


def live_seeds(seeds: DataFrame, probes: DataFrame) -> DataFrame:
    """Seeds with a live probe, once for each probe."""
    return seeds.join(probes.where("alive"), ["ccn", "mrf_url"])


def scoreboard(seeds: DataFrame, rediscovered: DataFrame, probes: DataFrame, registry: DataFrame, enforcement: DataFrame) -> DataFrame:
    """Every known source with its latest state, its facility and the facility's cases."""
    known = seeds.join(latest_probes(probes).select("ccn", "mrf_url", "http_status", "alive"), ["ccn", "mrf_url"], "left")
    known = known.select("ccn", F.col("mrf_url").alias("url"), "http_status", "alive", F.lit("seed").alias("source"), F.lit(0).alias("score"))
    found = rediscovered.select("ccn", F.col("candidate_url").alias("url"), F.col("head_status").alias("http_status"), "alive", F.lit("rediscovered").alias("source"), "score")
    cases = enforcement.groupBy("ccn").agg(F.count_distinct("case_id").alias("cases"))
    df = known.unionByName(found).join(registry.select("ccn", "name", "state"), "ccn", "left").join(cases, "ccn", "left")
    return df.withColumns({"cases": F.coalesce("cases", F.lit(0)), "alive": F.coalesce("alive", F.lit(False)), "name": F.coalesce("name", F.lit(""))})


def best_sources(seeds: DataFrame, rediscovered: DataFrame, probes: DataFrame) -> DataFrame:
    """The best live source of each facility: highest score, then latest; a seed has score one and wins ties."""
    a = live_seeds(seeds, probes).select("ccn", F.col("mrf_url").alias("url"), F.lit(1).alias("score"), F.col("probed_at").alias("at"), F.lit("seed").alias("source"))
    b = rediscovered.where("alive").select("ccn", F.col("candidate_url").alias("url"), "score", F.col("discovered_at").alias("at"), F.lit("rediscovered").alias("source"))
    order = F.struct("score", "at", "source", "url")
    return a.unionByName(b).groupBy("ccn").agg(F.max_by(F.struct("url", "score", "at", "source"), order).alias("b")).select("ccn", "b.*")


def live_ids(seeds: DataFrame, rediscovered: DataFrame, probes: DataFrame) -> DataFrame:
    """Facilities with a live source of either kind."""
    return live_seeds(seeds, probes).select("ccn").union(rediscovered.where("alive").select("ccn")).distinct()


def missing_required(registry: DataFrame, live: DataFrame) -> DataFrame:
    """Required facilities without a live source."""
    return registry.where("required").join(live, "ccn", "left_anti")


def missing_with_cases(registry: DataFrame, live: DataFrame, enforcement: DataFrame) -> DataFrame:
    return missing_required(registry, live).join(enforcement.select("ccn"), "ccn", "left_semi")


def cases_by_facility(enforcement: DataFrame) -> DataFrame:
    """Cases, actions, and the list of actions by date."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("date_of_action", "action", "row_id"))), lambda x: F.struct(x["date_of_action"].alias("date"), x["action"].alias("action")))
    return enforcement.groupBy("ccn").agg(F.count_distinct("case_id").alias("cases"), F.count("*").alias("n_actions"), listed.alias("actions"))


def action_counts(enforcement: DataFrame, k: int = 12) -> DataFrame:
    return enforcement.groupBy("action").agg(F.count("*").alias("n"), F.count_distinct("case_id").alias("cases")).orderBy(F.desc("n"), "action").limit(k)


def actions_by_year(enforcement: DataFrame) -> DataFrame:
    return enforcement.groupBy(F.year("date_of_action").alias("year")).agg(F.count("*").alias("n"))


def cases_by_state(enforcement: DataFrame, registry: DataFrame, k: int = 10) -> DataFrame:
    df = enforcement.join(registry.select("ccn", "state"), "ccn")
    return df.groupBy("state").agg(F.count_distinct("case_id").alias("cases")).orderBy(F.desc("cases"), "state").limit(k)


def facility_facts(registry: DataFrame, best: DataFrame, enforcement: DataFrame) -> DataFrame:
    """The registry with has_live and the number of cases."""
    cases = enforcement.groupBy("ccn").agg(F.count_distinct("case_id").alias("cases"))
    df = registry.join(best.select("ccn", F.lit(True).alias("has_live")), "ccn", "left").join(cases, "ccn", "left")
    return df.withColumns({"has_live": F.coalesce("has_live", F.lit(False)), "cases": F.coalesce("cases", F.lit(0))})


def per_mille(a: Column, b: Column) -> Column:
    """Whole per mille, rounded down; null without a base."""
    return F.when(b > 0, F.floor(1000 * a / b))


def site_summary(facts: DataFrame) -> DataFrame:
    """The one-row summary of the site."""
    missing = F.col("required") & ~F.col("has_live")
    df = facts.agg(
        F.count("*").alias("total"), F.count_if("required").alias("required"), F.count_if("has_live").alias("live"), F.count_if(F.col("required") & F.col("has_live")).alias("compliant"),
        F.count_if(missing).alias("missing"), F.count_if(F.col("cases") > 0).alias("under_enforcement"), F.count_if(missing & (F.col("cases") > 0)).alias("missing_with_cases"), F.sum("cases").alias("cases"),
    )
    return df.withColumn("compliant_per_mille", per_mille(F.col("compliant"), F.col("required")))


def coverage_by(facts: DataFrame, column: str, least: int = 0) -> DataFrame:
    """Total, live and share by state or type, of groups of at least ``least``."""
    df = facts.groupBy(column).agg(F.count("*").alias("total"), F.count_if("has_live").alias("live")).where(F.col("total") >= least)
    return df.withColumn("live_per_mille", per_mille(F.col("live"), F.col("total")))


def worst_states(facts: DataFrame, least: int = 10, k: int = 10) -> DataFrame:
    df = facts.where("required").groupBy("state").agg(F.count("*").alias("total"), F.count_if(~F.col("has_live")).alias("missing")).where(F.col("total") >= least)
    return df.withColumn("missing_per_mille", per_mille(F.col("missing"), F.col("total"))).orderBy(F.desc("missing_per_mille"), F.desc("total"), "state").limit(k)


def worst_offenders(facts: DataFrame, k: int = 25) -> DataFrame:
    """Facilities without a live source that have cases, most cases first."""
    return facts.where("NOT has_live AND cases > 0").orderBy(F.desc("cases"), "ccn").limit(k)


def coverage_report(registry: DataFrame, seeds: DataFrame, rediscovered: DataFrame, probes: DataFrame) -> DataFrame:
    """Distinct facilities live by seed, by rediscovery and by either, and required ones with a live source."""
    seed = live_seeds(seeds, probes).select("ccn", F.lit(1).alias("s"), F.lit(0).alias("r"))
    found = rediscovered.where("alive").select("ccn", F.lit(0).alias("s"), F.lit(1).alias("r"))
    flags = seed.union(found).groupBy("ccn").agg(F.max("s").alias("s"), F.max("r").alias("r"))
    df = registry.select("ccn", "required").join(flags, "ccn", "left")
    live = F.col("s").isNotNull()
    return df.agg(F.count_if(F.col("s") == 1).alias("by_seed"), F.count_if(F.col("r") == 1).alias("by_rediscovery"), F.count_if(live).alias("live"), F.count_if(live & F.col("required")).alias("required_live"), F.count_if("required").alias("required"))


def price_cohorts(registry: DataFrame, best: DataFrame, index: DataFrame) -> DataFrame:
    """Ten numbers on how the registry and the price index overlap; cohorts are joins, never differences of totals."""
    df = registry.select("ccn", "required", F.lit(True).alias("known")).join(best.select("ccn", F.lit(True).alias("live")), "ccn", "left")
    df = df.join(index.select("ccn", "n", F.lit(True).alias("indexed")), "ccn", "full_outer")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    cohort, priced = yes("required") & yes("live"), F.coalesce(F.col("n"), F.lit(0)) > 0
    return df.agg(
        F.count_if(yes("known")).alias("registry"), F.count_if(yes("indexed")).alias("indexed"), F.count_if(yes("indexed") & priced).alias("indexed_priced"), F.count_if(cohort).alias("cohort"),
        F.count_if(cohort & priced).alias("cohort_priced"), F.count_if(cohort & yes("indexed") & ~priced).alias("cohort_zero"), F.count_if(cohort & ~yes("indexed")).alias("cohort_unindexed"),
        F.count_if(yes("indexed") & priced & ~cohort).alias("priced_outside"), F.count_if(yes("indexed") & ~yes("known")).alias("indexed_unknown"), F.sum(F.coalesce("n", F.lit(0))).alias("items"),
    )


def status_histogram(probes: DataFrame) -> DataFrame:
    return probes.groupBy("http_status").agg(F.count("*").alias("n"), F.count_distinct("mrf_url").alias("urls"))


def states(registry: DataFrame, index: DataFrame) -> DataFrame:
    """Facilities and priced facilities of each state."""
    df = registry.join(index.where("n > 0").select("ccn", F.lit(1).alias("priced")), "ccn", "left")
    return df.groupBy("state").agg(F.count("*").alias("facilities"), F.count("priced").alias("priced"))


def failures_by_facility(failures: DataFrame) -> DataFrame:
    """(ccn, logs, reasons): distinct logs, and distinct reasons in order of first sight."""
    first = failures.groupBy("ccn", X.failure_reason(F.col("error")).alias("reason")).agg(F.min("at").alias("at"))
    logs = failures.groupBy("ccn").agg(F.count_distinct("log").alias("logs"))
    reasons = first.groupBy("ccn").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "reason"))), lambda x: x["reason"]).alias("reasons"))
    return logs.join(reasons, "ccn")


def host_clusters(gap: DataFrame, best: DataFrame, k: int = 15) -> DataFrame:
    """Hosts of the best sources of the given facilities, with an example; most facilities first."""
    df = gap.select("ccn").join(best, "ccn").withColumn("host", X.url_host(F.col("url")))
    return df.groupBy("host").agg(F.count("*").alias("n"), F.min("ccn").alias("example")).orderBy(F.desc("n"), "host").limit(k)


def trial_order(url: str = "url", norm: str = "norm") -> Column:
    """What decides the order of trying candidates, as a struct that Spark compares from its first field on.

    Each line is one sign: the places that its cases give, first case first, and the place without any; less is better."""
    u, n = F.col(url), F.col(norm)
    signs: list[tuple[list[tuple[Column, int]], Column | int]] = [
        ([(X.has_file_suffix(n), 0), (X.is_direct_file(n), 1)], 2),
        ([(X.is_protected_wrapper(u), 1), (X.is_html_wrapper(n), 1)], 0),
        ([], X.content_rank(F.col("content_type"))),
        ([], -F.col("hits")),
        ([(F.col("alive"), 0)], 1),
        ([(F.col("source") == "rediscovered", 0)], 1),
        ([], -F.col("score")),
    ]
    places = [X.choose(cases, rest) if cases else rest for cases, rest in signs]
    return F.struct(*[p.alias(f"sign_{i}") for i, p in enumerate(places)])


def ranked_candidates(seeds: DataFrame, rediscovered: DataFrame, probes: DataFrame, registry: DataFrame) -> DataFrame:
    """All usable candidate URLs of each facility in the order to try them; direct files whose probe failed in transit come as a fallback.

    Of equal normalized URLs the better one stays."""
    seeded = seeds.join(latest_probes(probes), ["ccn", "mrf_url"]).select("ccn", F.col("mrf_url").alias("url"), "content_type", F.lit(0).alias("score"), F.lit("seed").alias("source"), "alive", "http_status")
    found = rediscovered.select("ccn", F.col("candidate_url").alias("url"), F.col("head_content_type").alias("content_type"), "score", F.lit("rediscovered").alias("source"), "alive", F.col("head_status").alias("http_status"))
    usable = F.col("alive") | ((F.col("http_status") == -1) & X.is_direct_file(F.col("url")))
    df = seeded.unionByName(found).where(usable & ~X.is_rejected(F.col("url"), F.col("content_type"))).withColumn("norm", X.norm_url(F.col("url")))
    names = F.filter(F.split(F.lower(F.concat_ws(" ", "name", "city")), r"[^a-z0-9]+"), lambda t: F.length(t) >= 4)
    hits = F.size(F.filter(names, lambda t: F.contains(F.lower("norm"), t)))
    df = df.join(registry.select("ccn", "name", "city"), "ccn").withColumn("hits", hits).withColumn("place", trial_order())
    each = df.groupBy("ccn", "norm").agg(F.min_by(F.struct("url", "source", "score", "place"), "place").alias("x")).select("ccn", "norm", "x.*")
    return each.select("ccn", F.row_number().over(Window.partitionBy("ccn").orderBy("place", "norm")).alias("rank"), "url", "source", "score")


def first_urls(seeds: DataFrame, rediscovered: DataFrame) -> DataFrame:
    """The first URL of each facility, seeds before rediscovered ones."""
    a = seeds.where("mrf_url <> ''").groupBy("ccn").agg(F.min("mrf_url").alias("s"))
    b = rediscovered.where("candidate_url <> ''").groupBy("ccn").agg(F.min_by("candidate_url", F.struct(-F.col("score"), F.col("candidate_url"))).alias("r"))
    return a.join(b, "ccn", "full_outer").select("ccn", F.coalesce("s", "r").alias("url"))


def probe_history(probes: DataFrame, k: int = 10) -> DataFrame:
    """The last k probes of each facility, live ones first, newest first, as an array."""
    w = Window.partitionBy("ccn").orderBy(F.desc("alive"), F.desc("probed_at"), F.desc("event_id"))
    df = probes.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return df.groupBy("ccn").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "event_id", "http_status"))), lambda x: F.struct(x["event_id"].alias("event_id"), x["http_status"].alias("http_status"))).alias("history"))


def sample_facilities(index: DataFrame) -> DataFrame:
    """The smallest, the middle (upper one of two) and the largest facility by (items, ccn), in two aggregations."""
    df = index.where("n > 0").select("n", "ccn")
    ends = df.agg(F.min(F.struct("n", "ccn")).alias("first"), F.max(F.struct("n", "ccn")).alias("last"), F.count("*").alias("size"), upper_median("n").alias("middle"))
    below = df.crossJoin(F.broadcast(ends.select("middle", "size"))).where("n <= middle").groupBy("middle", "size").agg(F.count_if(F.col("n") < F.col("middle")).alias("below"))  # one row
    ties = df.join(F.broadcast(below), F.col("n") == F.col("middle")).withColumn("at", F.row_number().over(Window.partitionBy("n").orderBy("ccn")))
    middle = ties.where("below + at = size div 2 + 1").select("ccn", "n")
    return ends.select(F.explode(F.array("first", "last")).alias("x")).where("x IS NOT NULL").select("x.ccn", "x.n").unionByName(middle).distinct()
