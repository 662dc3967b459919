"""Set differences, index upserts and merges of generations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.functions import expressions as X
from pricefold.operators.indexes import code_coverage, packed_entries, ranked_codes, top_entries
from pricefold.sources.sinks import stored


def gap_sets(target: DataFrame, parsed: DataFrame, preview: DataFrame) -> DataFrame:
    """(gap, ccn) of target - parsed, parsed - preview, preview - parsed and target - preview.

    The sets' ids are written once, as each set takes part in two or three differences and is dear to make."""
    target, parsed, preview = (stored(x.select("ccn").distinct(), "ids") for x in (target, parsed, preview))
    pairs = {"target - parsed": (target, parsed), "parsed - preview": (parsed, preview), "preview - parsed": (preview, parsed), "target - preview": (target, preview)}
    parts = [a.join(b, "ccn", "left_anti").select(F.lit(k).alias("gap"), "ccn") for k, (a, b) in pairs.items()]
    return reduce(DataFrame.unionByName, parts)


def terminal_exceptions(gap: DataFrame, failures: DataFrame, existing: DataFrame, history: DataFrame) -> DataFrame:
    """Facilities of the gap whose last failure is a hard one and that aren't listed yet, with reason and probe history."""
    last = failures.groupBy("ccn").agg(F.max_by("error", F.struct("at", "log")).alias("error"))
    hard = last.where(X.is_hard_failure(F.col("error"))).select("ccn", X.failure_reason(F.col("error")).alias("reason"))
    return gap.select("ccn").join(hard, "ccn").join(existing.select("ccn"), "ccn", "left_anti").join(history, "ccn", "left")


def index_diff(live: DataFrame, local: DataFrame) -> DataFrame:
    """(ccn, side) of facilities that only one index has."""
    df = live.select("ccn", F.lit(1).alias("a")).join(local.select("ccn", F.lit(1).alias("b")), "ccn", "full_outer").where("a IS NULL OR b IS NULL")
    return df.select("ccn", F.when(F.col("b").isNull(), "live only").otherwise("local only").alias("side"))


def upserted(old: DataFrame, new: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """The index after the new rows of the key set, with what became of each: added, 0 to n, n to 0, changed, same or kept."""
    if keys is not None:
        new = new.join(keys.select("ccn"), "ccn", "left_semi")
    rest = [c for c in old.columns if c != "ccn"]
    a, b = old.select("ccn", F.struct(*rest).alias("a")), new.select("ccn", F.struct(*rest).alias("b"))
    df = a.join(b, "ccn", "full_outer")
    n = lambda s: F.coalesce(F.col(f"{s}.n"), F.lit(0))
    diff = X.choose([(F.col("b").isNull(), "kept"), (F.col("a").isNull(), "added"), ((n("a") == 0) & (n("b") > 0), "0 to n"), ((n("a") > 0) & (n("b") == 0), "n to 0"), (F.col("a").eqNullSafe(F.col("b")), "same")], "changed")
    return df.select("ccn", F.coalesce("b", "a").alias("r"), diff.alias("diff")).select("ccn", "r.*", "diff")


def _disjoint(owners: DataFrame, wave: str) -> DataFrame:
    """One row without columns of note; an error when it is computed, if several waves have one facility."""
    twice = owners.groupBy("ccn").agg((F.min(wave) < F.max(wave)).alias("twice")).agg(F.count_if("twice").alias("k"))
    return twice.select(F.when(F.col("k") > 0, F.raise_error(F.concat("k", F.lit(" facilities are in several shards")))).cast("boolean").alias("__error"))


def merged_waves(shards: list[DataFrame], k_codes: int = 5000, k_entries: int = 25) -> DataFrame:
    """Code entries of all shards, grouped anew: ranked codes with their packed top entries.

    A facility that several shards have is an error, raised when the result is computed. Entries and ranked codes are
    written once, as coverage, lists and the check would each make the shards' entries anew."""
    entries = stored(reduce(DataFrame.unionByName, [x.withColumn("__shard", F.lit(i)) for i, x in enumerate(shards)]), "entries")
    twice = _disjoint(entries, "__shard")
    entries = entries.drop("__shard")
    ranked = stored(ranked_codes(code_coverage(entries), k_codes), "ranked")
    merged = ranked.join(packed_entries(top_entries(entries.join(ranked.select("code"), "code", "left_semi"), k_entries)), "code")
    return merged.crossJoin(twice).where("__error IS NULL").drop("__error")  # one row


def wave_state(entries: DataFrame, k_entries: int = 25) -> tuple[DataFrame, DataFrame]:
    """What a wave hands on to later merges in place of its entries: each code's counts and first ``k_entries``, and the facilities.

    Its size goes with codes and facilities, not with entries."""
    return code_coverage(entries).join(packed_entries(top_entries(entries, k_entries)), "code"), entries.select("ccn").distinct()


def merged_states(codes: DataFrame, owners: DataFrame, k_codes: int = 5000, k_entries: int = 25, wave: str = "wave") -> DataFrame:
    """The result of :func:`merged_waves` from the states of all waves, each row with its wave; no entry is read again.

    The states' lists need ``k_entries`` at least. Facilities of a code add up, as no facility is in two waves, which is
    checked as there."""
    ranked = ranked_codes(codes.groupBy("code").agg(F.sum("n_entries").alias("n_entries"), F.sum("facilities").alias("facilities")), k_codes)
    listed = codes.join(ranked.select("code"), "code", "left_semi").select("code", F.explode("entries").alias("e")).select("code", "e.*")
    merged = ranked.join(packed_entries(top_entries(listed, k_entries)), "code")
    return merged.crossJoin(_disjoint(owners, wave)).where("__error IS NULL").drop("__error")  # one row


def overlaid(old: DataFrame, fresh: DataFrame, dropped: list[str]) -> DataFrame:
    """The one-row summary with fresh fields over preserved ones; cohort fields go, as they must be counted again."""
    kept = [c for c in old.columns if c not in fresh.columns and c not in dropped]
    return fresh.crossJoin(old.select(*kept).limit(1)) if kept else fresh


def carried_forward(new: DataFrame, live: DataFrame) -> DataFrame:
    """The new generation, and the live facilities that it hasn't."""
    return new.withColumn("carried", F.lit(False)).unionByName(live.join(new.select("ccn"), "ccn", "left_anti").withColumn("carried", F.lit(True)))


def drift(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """(path, state) of outputs that changed, vanished or are new since their hashes were recorded."""
    df = recorded.select("path", F.col("sha256").alias("a")).join(found.select("path", F.col("sha256").alias("b")), "path", "full_outer")
    state = X.choose([(F.col("b").isNull(), "vanished"), (F.col("a").isNull(), "new"), (F.col("a") != F.col("b"), "changed")], "same")
    return df.select("path", state.alias("state"))


def liveness_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Newly live, newly dead and unchanged facilities between two snapshots (ccn, has_live)."""
    df = before.select("ccn", F.col("has_live").alias("a")).join(after.select("ccn", F.col("has_live").alias("b")), "ccn", "full_outer").fillna(False)
    return df.agg(F.count_if(~F.col("a") & F.col("b")).alias("newly_live"), F.count_if(F.col("a") & ~F.col("b")).alias("newly_dead"), F.count_if(F.col("a") == F.col("b")).alias("unchanged"))
