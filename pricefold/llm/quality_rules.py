"""Quality rules with risk-controlled thresholds. Built-in DataFrame functions only.

Each rule compares a ratio of a document with a cutoff and rejects what lies above it. Cutoffs come from labelled
holdouts: for each stratum (a band of document length) and rule, the lowest cutoff of a fixed grid is taken at which
the exact binomial (Clopper-Pearson) upper bound on the share of good documents rejected stays within the rule's part of
``risk``. The rules share ``risk`` equally, so all of them together reject at most ``risk`` of a stratum's good
documents; this holds for all strata at once with probability ``1 - delta``. Multiple testing: Bonferroni over strata and
rules. The cutoffs of one rule are nested, and are tested as a fixed sequence from the loosest down to the first failure;
as fewer rejections never make a bound worse, that is the lowest cutoff that passes, and the sequence costs no more than
one test. A rule without such a cutoff rejects nothing.

Defined results: a null or blank text has no words and fails the base rules; repeated documents are judged alike;
labels that are null or have no document don't count; without labels only the base rules reject.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import BLANK, without

#: Share of good documents that the rules may reject in a stratum, and the chance that any of the bounds fails.
RISK, DELTA = 0.04, 0.05
#: Upper ends of the strata, in words.
BANDS = (200, 1000, 5000)
#: Cutoffs tried for every rule.
GRID = (0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
RULES = ("symbols", "marks", "capitals", "lines", "repeats")
SYMBOLS = "#*$%&|<>"
#: Documents with fewer words, or with a larger share of repeated words, fail whatever the labels say.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count(text: Column, characters: str) -> Column:
    """Code points that the character class matches."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def _adjacent_equal(s: Column, value) -> Column:
    """For a sorted array: ``value(a, b)`` of each two neighbours, nulls removed."""
    less = F.greatest(F.size(s) - 1, F.lit(0))
    return F.filter(F.zip_with(F.slice(s, 1, less), F.slice(s, 2, less), value), lambda x: x.isNotNull())


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the base statistics (long) and the rules' ratios ``r_<rule>`` (double), each over the whole text.

    Repeated words: hashes of the 3-word windows are sorted; most texts then show no equal neighbours and are done. In
    the others hashes are sorted with their places, equal neighbours give the places that occur again, and the gaps
    between those places say how many words they cover. Sorting keeps long texts at n log n."""
    names = (*BASE, *[f"r_{r}" for r in RULES])
    df = without(docs.withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit(""))), *names)
    t = F.col("__text")
    df = df.withColumn("__w", F.array_remove(F.split(t, f"[{BLANK}]+"), ""))
    n = F.greatest(F.size("__w") - 2, F.lit(0))
    pairs = F.zip_with(F.slice("__w", 1, n), F.slice("__w", 2, n), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("__h", F.zip_with(pairs, F.slice("__w", 3, n), lambda ab, c: F.xxhash64(ab, c)))
    df = df.withColumn("__sorted", F.sort_array("__h"))
    twice = F.size(F.array_distinct("__sorted")) < F.size("__sorted")
    placed = F.when(twice, F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("__s", placed)
    places = _adjacent_equal(F.col("__s"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    df = df.withColumn("__r", F.when(F.col("__s").isNotNull(), F.sort_array(F.array_distinct(F.flatten(places)))))
    less = F.greatest(F.size("__r") - 1, F.lit(0))
    gaps = F.zip_with(F.slice("__r", 1, less), F.slice("__r", 2, less), lambda a, b: F.least(b - a, F.lit(3)))
    repeats = F.when(F.size("__r") > 0, F.aggregate(gaps, F.lit(3), lambda x, g: x + g)).otherwise(F.lit(0))
    df = df.withColumn("__lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{BLANK}]")))
    df = df.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_symbols": _count(t, SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeats.cast("long"),
    })
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    df = df.withColumns({
        "r_symbols": ratio(F.col("n_symbols"), F.col("word_chars")),
        "r_marks": ratio(_count(t, "!?"), F.col("word_chars")),
        "r_capitals": ratio(F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")), F.col("word_chars")),
        "r_lines": ratio(F.col("n_dup_lines"), F.size("__lines")),
        "r_repeats": ratio(F.col("n_repeat_words"), F.col("n_words")),
    })
    return df.drop("__text", "__w", "__h", "__sorted", "__s", "__r", "__lines")


def base_failed(max_repeat: int = MAX_REPEAT_PERCENT, min_words: int = MIN_WORDS) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


def stratum() -> Column:
    out = F.lit(len(BANDS))
    for i in reversed(range(len(BANDS))):
        out = F.when(F.col("n_words") < BANDS[i], F.lit(i)).otherwise(out)
    return out


def _log_gamma(x: Column) -> Column:
    """For x >= 1: shifted by eight, then Stirling's series; absolute error below 1e-11."""
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    y = x + 8
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - F.log(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p): terms from k downwards, each from the one before, while they can matter (k is at most n)."""
    log_term = _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0) + k * math.log(p) + (n - k) * math.log1p(-p)
    steps = F.least(k, (40 * F.sqrt(n) + 40).cast("long"))
    odds = (1 - p) / p
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def down(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i) / (n - k + i + 1) * odds
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.when(steps > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), steps - 1), start, down)["sum"]).otherwise(F.lit(1.0))
    # above the mean the sum no longer matters: such a k never shows a rate below p at a small level
    return F.when(k >= n, F.lit(1.0)).when(k > n * p, F.lit(1.0)).otherwise(F.exp(log_term) * total)


def calibrate(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cut_<rule>...), at most one row for each band, from documents with statistics and a column ``quality``.

    A cutoff is safe if its k rejected of n good documents would be as few with chance ``delta / tests`` at most, were
    the true rate the rule's part of ``risk``; that is the Clopper-Pearson bound read the other way round."""
    tests, part = (len(BANDS) + 1) * len(RULES), risk / len(RULES)
    good = labelled.where((F.col("quality") == 1) & ~base_failed()).withColumn("stratum", stratum())
    counts = good.groupBy("stratum").agg(F.count("*").alias("n"), *[F.count_if(F.col(f"r_{r}") > c).alias(f"k_{r}_{i}") for r in RULES for i, c in enumerate(GRID)])
    tried = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cut"), F.col(f"k_{r}_{i}").alias("k")) for r in RULES for i, c in enumerate(GRID)])).alias("t")
    safe = counts.select("stratum", "n", tried).select("stratum", "n", "t.*").where(binomial_tail(F.col("k"), F.col("n"), part) <= delta / tests)
    return safe.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])


def judge(statistics: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``statistics`` plus base_failed, rejected_by (the first rule that rejects, else null) and kept.

    ``cutoffs`` has at most a row for each band, which bounds its broadcast."""
    names = ("base_failed", "rejected_by", "kept")
    df = without(statistics, *names).withColumn("__stratum", stratum())
    df = df.join(F.broadcast(cutoffs.withColumnsRenamed({c: f"__{c}" for c in cutoffs.columns})), "__stratum", "left")
    hits = [F.when(F.coalesce(F.col(f"r_{r}") > F.col(f"__cut_{r}"), F.lit(False)), F.lit(r)) for r in RULES]
    df = df.withColumns({"base_failed": base_failed(), "rejected_by": F.coalesce(*hits)})
    df = df.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
    return df.drop("__stratum", *[f"__cut_{r}" for r in RULES])
