"""Target-distribution importance resampling: draws the documents whose hashed n-grams are likelier in the target's texts.

A feature is a run of ``low`` to ``high`` consecutive words of a text; its bucket is the crc32 of its words, joined by one
blank, modulo ``buckets``. A bucket's gain is the floor of 1000 times the log ratio of its smoothed shares in target and
corpus, a document's weight is the sum of its features' gains, and its score adds Gumbel noise that only the seed and the
id decide: the highest scores are a draw without replacement in proportion to the weights' exponentials.

Texts are read in batches that are joined with a separator sentinel: one regex pass finds all words, their documents come
from a binary search among the texts' ends, runs across two documents are masked, and what is left is counted by bincount.
The driver sees ``buckets`` numbers. Ranks come from ranges of the order, so no task sees all rows.

Defined results: a null or empty text, or one without words, has no features and weight 0. Rows with equal ids have equal
noise. A null id hashes like an empty one and comes last among ties; ties of score and id are ordered by weight. An empty
target or corpus only leaves the smoothing. Columns of the input named like a result are replaced; case doesn't count.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricefold.llm.common import small_batches, stored, without

#: Words in UTF-8 after lower-casing: digits, a-z, and all characters beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SENTINEL = b"\x00"
#: Bytes of text joined at once (a longer text is a batch of its own), and words looked at in one step.
JOINED, STEP = 1 << 20, 1 << 17
#: Rows of one range when ranks are given.
RANGE = 1_000_000


@dataclass(frozen=True)
class Features:
    """Runs of ``low`` to ``high`` words in so many buckets."""

    low: int = 1
    high: int = 1
    buckets: int = 10_000


def batches_of(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of batches of about ``JOINED`` bytes."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > JOINED:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held


def found_features(texts: list[bytes], how: Features) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, document, bucket) of all runs of n words in a batch, step by step; documents are places in ``texts``."""
    joined = SENTINEL.join(texts).lower()
    ends = np.cumsum([len(t) + 1 for t in texts])
    words: list[bytes] = []
    docs = np.zeros(0, np.int64)
    matches = WORD.finditer(joined)
    while more := [(m.start(), m.group()) for m in islice(matches, STEP)]:
        old = len(words)  # the last words of the step before: runs may begin there, but end in this one
        words += [w for _, w in more]
        docs = np.append(docs, np.searchsorted(ends, [at for at, _ in more], side="right"))
        crcs = [zlib.crc32(w) for w in words]
        for n in range(1, how.high + 1):
            if n > 1:
                crcs = [zlib.crc32(b" " + w, c) for w, c in zip(words[n - 1 :], crcs, strict=False)]
            last = np.arange(n - 1, len(words))
            inside = (docs[: len(last)] == docs[last]) & (last >= old)
            if n >= how.low:
                yield n, docs[last][inside], np.array(crcs, np.int64)[inside] % how.buckets
        kept = max(0, len(words) - how.high + 1)
        words, docs = words[kept:], docs[kept:]


def bucket_counts(df: DataFrame, text: str = "text", how: Features = Features()) -> np.ndarray:
    """How many features of all texts lie in each bucket."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(how.buckets, np.int64)
        for pdf in batches:
            for _, texts in batches_of([t or b"" for t in pdf["t"]]):
                for _, _, bucket in found_features(texts, how):
                    total += np.bincount(bucket, minlength=how.buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    with small_batches(df.sparkSession):
        rows = df.select(F.col(f"`{text}`").cast("binary").alias("t")).mapInPandas(work, "bucket long, n long")
        found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # a row for each bucket at most
    out = np.zeros(how.buckets, np.int64)
    out[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))."""
    buckets = len(corpus)
    up = (target + 1.0) * float(corpus.sum() + buckets)
    down = (corpus + 1.0) * float(target.sum() + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def with_weight(docs: DataFrame, gain: np.ndarray, text: str = "text", how: Features = Features()) -> DataFrame:
    """``docs`` plus n_words, n_features and weight; ``text`` is gone."""
    rest = without(docs.withColumn("__text", F.col(f"`{text}`").cast("binary")), text, "n_words", "n_features", "weight")
    numbers = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    shared = docs.sparkSession.sparkContext.broadcast(gain.astype(np.float64))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            all_texts = [t or b"" for t in pdf.pop("__text")]
            out = np.zeros((3, len(all_texts)))
            for first, texts in batches_of(all_texts):
                at = slice(first, first + len(texts))
                for n, doc, bucket in found_features(texts, Features(1, how.high, how.buckets)):
                    many = np.bincount(doc, minlength=len(texts))
                    out[0, at] += many * (n == 1)
                    if n >= how.low:
                        out[1, at] += many
                        out[2, at] += np.bincount(doc, weights=shared.value[bucket], minlength=len(texts))
            yield pdf.assign(**{f.name: out[i].astype(np.int64) for i, f in enumerate(numbers)})

    with small_batches(docs.sparkSession):
        return rest.mapInPandas(work, T.StructType([*without(rest, "__text").schema.fields, *numbers]))


def with_score(weighed: DataFrame, seed: int = 2024, doc_id: str = "doc_id") -> DataFrame:
    """Adds score: weight plus Gumbel noise in thousandths, from the first 32 bits of sha256 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return without(weighed, "score").withColumn("score", F.col("weight") + noise)


def drawn(scored: DataFrame, percent: int = 10, min_words: int = 20, doc_id: str = "doc_id") -> DataFrame:
    """Adds rank: 1, 2, ... of the floor(percent N / 100) highest scores among the N rows of ``min_words`` words, else null.

    The rows are dealt out by ranges of the order and written; a row's rank is its place in its range plus the sizes of the
    ranges before, of which the driver sees one number each."""
    spark = scored.sparkSession
    fits = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    base = stored(without(scored, "rank", "__fits", "__range").withColumn("__fits", fits), "scores")
    n, rows = base.agg(F.count_if("__fits"), F.count("*")).first()
    order = [F.desc("__fits"), F.desc("score"), F.asc_nulls_last(f"`{doc_id}`"), F.desc("weight")]
    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // RANGE + 1)
    ranges = stored(base.repartitionByRange(many, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = sorted((r["__range"], r["count"]) for r in ranges.groupBy("__range").count().collect())
    before = dict(zip([k for k, _ in sizes], np.cumsum([0, *[c for _, c in sizes]]).tolist(), strict=False))
    offsets = spark.createDataFrame(list(before.items()) or [(0, 0)], "__range int, __before long")
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    at = F.col("__before") + F.col("__place")
    ranked = ranges.withColumn("__place", place).join(F.broadcast(offsets), "__range")
    return ranked.withColumn("rank", F.when(F.col("__fits") & (at <= percent * n // 100), at)).drop("__fits", "__range", "__place", "__before")


def resampled(docs: DataFrame, target: DataFrame, text: str = "text", how: Features = Features(), percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """``docs`` without its text, with n_words, n_features, weight, score and rank."""
    gain = gains(bucket_counts(docs, text, how), bucket_counts(target, text, how))
    return drawn(with_score(with_weight(docs, gain, text, how), seed), percent, min_words)
