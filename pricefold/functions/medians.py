"""The three medians of price lists: as aggregates, and exactly with bounded state for keys that hold very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def upper_median(c: str) -> Column:
    """The value at place n // 2 of the ascending list: the upper one of the middle two."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c} DESC)")


def true_median(c: str) -> Column:
    """The mean of the middle two."""
    return F.percentile(F.col(c), 0.5)


def at_share(c: str, share: float) -> Column:
    """The value at place floor(n * share) of the ascending list, for a share below 1: counted from above, so that whole
    multiples fall on the next place. The state is a count for each distinct value, never a list of all."""
    return F.expr(f"percentile_disc({1 - share:.10g}) WITHIN GROUP (ORDER BY {c} DESC)")


#: Accuracy of the sketch: it places a value within an n-th of the rows, so a bracket holds about six of ``ACCURACY`` rows.
ACCURACY = 10_000


def exact_places(df: DataFrame, keys: list[str], value: str, places: dict[str, tuple[float, Column]]) -> DataFrame:
    """keys, n and, for each name, the value at a place of the key's ascending list of values (nulls left out), exactly.

    ``places`` has for each name its share of the list, and its place from 0 as an expression of ``n``. A mergeable sketch
    brackets each place by two values; a second pass counts every value inside a bracket, and only the number of those
    between brackets. So a key's state is a sketch and some ``6 / ACCURACY`` of its distinct values, never all of them, and
    a hot key is counted by all tasks. Keys of up to ``ACCURACY`` values have one bracket: all of them."""
    priced = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    margin = 3 / ACCURACY
    shares = sorted({s for s, _ in places.values()})
    asked = [min(1.0, max(0.0, s + side * margin)) for s in shares for side in (-1, 1)]
    sketch = priced.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile_approx("__v", asked, ACCURACY).alias("__at"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    some = lambda i: F.struct(F.col("__at")[2 * i].alias("low"), F.col("__at")[2 * i + 1].alias("high"))
    small = F.array(F.struct(F.col("__low").alias("low"), F.col("__high").alias("high")))
    sketch = sketch.select(*keys, "n", F.when(F.col("n") <= ACCURACY, small).otherwise(F.array(*[some(i) for i in range(len(shares))])).alias("__brackets"))
    joined = priced.join(sketch.select(*keys, "__brackets"), keys)
    inside = F.exists("__brackets", lambda b: (F.col("__v") >= b["low"]) & (F.col("__v") <= b["high"]))
    # what lies between two brackets is counted at the end of the one before
    end = F.coalesce(F.array_max(F.filter(F.transform("__brackets", lambda b: b["high"]), lambda h: h < F.col("__v"))), F.lit(float("-inf")))
    counted = joined.select(*keys, F.when(inside, F.col("__v")).otherwise(end).alias("__v"), (~inside).alias("__outside")).groupBy(*keys, "__v", "__outside").agg(F.count("*").alias("__many"))
    upto = F.sum("__many").over(Window.partitionBy(*keys).orderBy("__v", "__outside").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("__upto", upto).where("NOT __outside").join(sketch.select(*keys, "n"), keys)
    at = lambda place: F.max(F.when((place < F.col("__upto")) & (place >= F.col("__upto") - F.col("__many")), F.col("__v")))
    return ranked.groupBy(*keys, "n").agg(*[at(place).alias(name) for name, (_, place) in places.items()])


def exact_shares(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys, n and for each name the value at place floor(n * share) of the ascending list, for shares below 1."""
    return exact_places(df, keys, value, {name: (s, F.least(F.floor(F.col("n") * F.lit(s) + 1e-9), F.col("n") - 1)) for name, s in shares.items()})


def exact_medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, upper_median and true_median, as the aggregates of these names give them."""
    out = exact_places(df, keys, value, {"__lower": (0.5, F.floor((F.col("n") - 1) / 2)), "upper_median": (0.5, F.floor(F.col("n") / 2))})
    return out.withColumn("true_median", (F.col("__lower") + F.col("upper_median")) / 2).drop("__lower")
