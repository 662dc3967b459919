"""Filter interaction audit: what each filter of a cascade removes, in every order of the filters.

Documents are reduced to a table of failure masks with counts for each part; Spark does that with built-in functions. From
a part's masks (2^n at most) one decision diagram is built: level i tests the i-th filter, a node leads to its pass and its
fail child, equal nodes are one, leaves carry counts, and every node knows the counts below it. Orders follow each other by
swaps of two adjacent levels, which rewrite those two levels only; along an order's all-pass path, what lies below a fail
child is what that step removes.

Defined results: a null text is empty; a null part is the empty string; rows count one by one, repeated ones too. Filter E
compares ids: rows of the smallest id pass, and a null id neither fails nor makes others fail. Of several labels of an id,
one that says so is enough; a null id has none. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricefold.llm.common import BLANK, UPPER

LETTERS = "ABCDE"
#: What is counted in leaves: documents, those labelled good, those labelled toxic.
Weight = tuple[int, int, int]
STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def words_of(text: Column) -> Column:
    inner = F.trim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{BLANK}]+"))


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, the text's digest, and the bits of the filters A to D that it fails (A is bit 0)."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("t"), words_of(text).alias("w"))
    n, capitals = F.size("w"), F.length(F.regexp_replace("t", f"[^{UPPER[0]}-{UPPER[-1]}]+", ""))
    fails = [n < 100, 100 * F.size(F.array_distinct("w")) < 80 * n, 100 * capitals > 10 * F.length("t"), F.col("t").rlike("[#$%&*|]")]
    bits = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))
    return df.select("doc_id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), bits.alias("bits"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail exactly the filters of a mask.

    Copies aren't joined with each other: they are counted by (digest, part, labels), and of a digest's few rows those of
    the smallest id are told from the rest."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flag = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    df = failures(docs).join(known, "doc_id", "left").select("doc_id", "part", "digest", "bits", flag("good"), flag("toxic"))
    kind = ["digest", "part", "bits", "good", "toxic"]
    ids = df.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))  # repeated rows of one id
    has = F.col("doc_id").isNotNull()
    groups = ids.groupBy(*kind).agg(F.min(F.when(has, F.struct("doc_id", "n"))).alias("first"), F.sum("n").alias("n"), F.sum(F.when(~has, F.col("n")).otherwise(0)).alias("nameless"))
    lowest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("lowest"), F.col("first.n")).otherwise(0)
    told = groups.withColumn("lowest", lowest).withColumn("passing", passing)
    both = F.array(F.struct(F.col("bits").alias("mask"), F.col("passing").alias("n")), F.struct((F.col("bits") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))
    masks = told.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return masks.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def plus(a: Weight, b: Weight) -> Weight:
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2])


class Diagram:
    """Counts of failure masks as a decision diagram: ``levels[i]`` holds (pass, fail) places in level i + 1.

    The last level's children are leaves; ``below[i]`` has the counts below each node of level i (leaves last). A level is
    never skipped, and no two nodes of a level are equal, so an order of filters has one diagram."""

    def __init__(self, counts: dict[int, Weight], n: int) -> None:
        self.order = list(range(n))
        places: list[dict] = [{} for _ in range(n + 1)]

        def node(level: int, mask: int) -> int:
            key = counts.get(mask, (0, 0, 0)) if level == n else (node(level + 1, mask), node(level + 1, mask | 1 << level))
            return places[level].setdefault(key, len(places[level]))

        node(0, 0)
        self.levels: list[list[tuple[int, int]]] = [list(p) for p in places[:n]]
        self.below: list[list[Weight]] = [[] for _ in range(n)] + [list(places[n])]
        for i in reversed(range(n)):
            self.below[i] = [plus(self.below[i + 1][a], self.below[i + 1][b]) for a, b in self.levels[i]]

    def swap(self, i: int) -> None:
        """Exchanges the filters of levels i and i + 1; nodes of level i keep their places, what is above and below stays."""
        places: dict[tuple[int, int], int] = {}
        lower = self.levels[i + 1]
        cross = lambda a, b, side: places.setdefault((lower[a][side], lower[b][side]), len(places))
        self.levels[i] = [(cross(a, b, 0), cross(a, b, 1)) for a, b in self.levels[i]]
        self.levels[i + 1] = list(places)
        self.below[i + 1] = [plus(self.below[i + 2][a], self.below[i + 2][b]) for a, b in places]
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """(filter, kept, removed) along the path on which everything passes."""
        at = 0
        for i, level in enumerate(self.levels):
            at, failed = level[at]
            yield self.order[i], self.below[i + 1][at], self.below[i + 1][failed]


def adjacent_swaps(n: int) -> Iterator[int]:
    """The n! - 1 places of adjacent swaps that lead through all orders of n things (each moves through those before it)."""
    if n > 1:
        inner = adjacent_swaps(n - 1)
        for turn in range(factorial(n - 1)):
            down = turn % 2 == 0
            yield from reversed(range(n - 1)) if down else range(n - 1)
            if (step := next(inner, None)) is not None:
                yield step + 1 if down else step


def audit_part(part: str, counts: dict[int, Weight], letters: str) -> pd.DataFrame:
    """All orders' steps of one part."""
    n = len(letters)
    diagram = Diagram(counts, n)
    found: list[tuple[list[int], list[tuple[int, Weight, Weight]]]] = [([*diagram.order], [*diagram.steps()])]
    for i in adjacent_swaps(n):
        diagram.swap(i)
        found.append(([*diagram.order], [*diagram.steps()]))
    fails, alone, shapley = [0] * n, [0] * n, [0] * n
    for _, steps in found:
        fails[steps[0][0]] = steps[0][2][0]  # the first filter removes all that fail it, the last those that fail nothing else
        alone[steps[-1][0]] = steps[-1][2][0]
        for f, _, removed in steps:
            shapley[f] += removed[0]
    out = [(part, "".join(letters[f] for f in order), i + 1, kept[0], gone[0], fails[f] - gone[0], alone[f], gone[1], gone[2], shapley[f]) for order, steps in found for i, (f, kept, gone) in enumerate(steps)]
    return pd.DataFrame(out, columns=[c.split()[0] for c in STEPS.split(", ")])


def audited(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Steps of all orders for each part; ``masks`` as from :func:`mask_counts`, one bit for each letter."""

    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:  # 2^n rows at most
        rows = zip(pdf["mask"], pdf["n"], pdf["good"], pdf["toxic"], strict=True)
        return audit_part(key[0], {int(m): (int(n), int(g), int(t)) for m, n, g, t in rows}, letters)

    return masks.groupBy("part").applyInPandas(work, STEPS)
