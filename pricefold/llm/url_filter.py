"""URL filters: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

Everything is built-in DataFrame functions. The filter is a table of at most ``n_blocks`` rows of 256 bits, so its
broadcast has a fixed bound (40 bytes a row); more listed URLs raise the share of false positives, never the size.
Only possible hits travel to the exact join, which removes the false positives.

Defined results: a null url, or one without ``://``, has host and path ``''``, fits no rule, is never listed and is
allowed. Repeated pages give repeated rows. Empty tables give empty results. Input columns named like an output column
are replaced; all others are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import ascii_lower, without

#: 2 ** 18 blocks of 256 bits: 32 bits for each of two million listed URLs, and 10 MB to broadcast at most.
N_BLOCKS = 1 << 18
LANES = 4


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without ``.html`` or a last ``/``, and the query's sorted parameters without tracking ones.

    Scheme and fragment don't count. Null where there is no host."""
    host = F.regexp_replace(url_host(url), r"^(www|m)\.", "")
    path = F.regexp_replace(url_path(url), r"(\.html|/)$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)=")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]], what: int) -> Column:
    """Of the rules (``host/path``, verdict) that fit, the longest one's text (what=0) or verdict (what=1); else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rule_path = rule[0].partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        out = F.when(fits, F.lit(rule[what])).otherwise(out)
    return out


def _block(canonical: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(canonical), F.lit(n_blocks)).cast("int")


def _masks(canonical: Column) -> list[Column]:
    """Eight bits, one in each 32-bit half of four words, from a hash that is independent of the block's."""
    h = F.xxhash64(canonical, F.lit("lanes"))
    bit = lambda i: F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")
    one = lambda i, by: F.call_function("shiftleft", F.lit(1).cast("long"), bit(i) + by)
    return [one(2 * j, 0).bitwiseOR(one(2 * j + 1, 32)) for j in range(LANES)]


def bloom_filter(listed: DataFrame, n_blocks: int = N_BLOCKS) -> DataFrame:
    """(block, w0..w3) of the column ``canonical``; at most ``n_blocks`` rows, built with map-side partial ORs."""
    keys = listed.select(_block(F.col("canonical"), n_blocks).alias("block"), *[m.alias(f"w{j}") for j, m in enumerate(_masks(F.col("canonical")))])
    return keys.groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(LANES)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", n_blocks: int = N_BLOCKS) -> DataFrame:
    """``pages`` plus host, path, rule, verdict and listed.

    ``listed`` has a column ``canonical``, as made by :func:`canonical_url`; nulls and repeats in it don't matter.
    The verdict is that of the longest fitting rule, else ``block`` for listed URLs and ``allow`` for others."""
    names = ("host", "path", "rule", "verdict", "listed")
    exact = listed.select("canonical").where(F.col("canonical").isNotNull()).groupBy("canonical").agg(F.lit(True).alias("__listed"))
    words = bloom_filter(exact, n_blocks).withColumnsRenamed({"block": "__block"} | {f"w{j}": f"__w{j}" for j in range(LANES)})
    probe = without(pages.withColumn("__url", F.col(f"`{url}`")), *names)
    probe = probe.withColumns({"host": url_host(F.col("__url")), "path": url_path(F.col("__url")), "__canonical": canonical_url(F.col("__url"))})
    probe = probe.withColumn("__block", _block(F.col("__canonical"), n_blocks)).join(F.broadcast(words), "__block", "left")
    possible = F.col("__canonical").isNotNull()
    for j, mask in enumerate(_masks(F.col("__canonical"))):
        possible = possible & (F.coalesce(F.col(f"__w{j}"), F.lit(0)).bitwiseAND(mask) == mask)
    probe = probe.drop(*[f"__w{j}" for j in range(LANES)], "__block")
    hits = probe.where(possible).join(exact.withColumnRenamed("canonical", "__canonical").hint("shuffle_hash"), "__canonical", "left")
    both = hits.unionByName(probe.where(~possible).withColumn("__listed", F.lit(False)))
    both = both.withColumn("listed", F.coalesce("__listed", F.lit(False)))
    both = both.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules, 0))
    by_rule = fitting_rule(F.col("host"), F.col("path"), rules, 1)
    both = both.withColumn("verdict", F.coalesce(by_rule, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))))
    kept = [c for c in pages.columns if c.lower() not in names]
    return both.select(*[F.col(f"`{c}`") for c in kept], *names)
