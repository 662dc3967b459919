"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text's features are its byte trigrams, hashed to ``DIMENSION`` buckets, and a few bands that describe its surface
(share of distinct words, of repeated lines, of capitals, of symbols). Trigrams weigh sqrt(count) times idf; idf comes
from all documents. A bounded, deterministic sample of ``SAMPLE`` labelled rows gives the latent space (a randomised
SVD) and the voters. Every document is compared with every voter by exact cosine products in blocks, and its ``K``
nearest voters vote with their similarity's power ``SHARPNESS``.

Of voters that are equally near at the ``K``-th place, those earlier in the voters' order (by vector, then label) vote.

Defined results: null and empty texts have the same features (those of no words) and get a score as any text; repeated
rows get equal scores; without usable labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.llm import latent
from pricefold.llm.common import bucket_of, stored, without

DIMENSION, BANDS = 4096, 64
#: Labelled rows used to fit, at most (in expectation); latent dimensions; voters heard.
SAMPLE, RANK, K, SHARPNESS = 6000, 64, 15, 8
#: Weight of a surface band against a trigram part of length one.
BAND_WEIGHT = 0.45
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
BLOCK = 512


def trigram_counts(text: str) -> np.ndarray:
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIMENSION, np.int64)
    h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(20)
    return np.bincount(h, minlength=DIMENSION)


def bands(text: str) -> list[int]:
    """One of eight places for each of six surface measures."""
    raw = text.encode("utf-8", "replace")
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = max(1, len(words))
    letters = np.frombuffer(raw, np.uint8)
    capitals = np.count_nonzero((letters >= 65) & (letters <= 90)) / max(1, len(raw))
    signs = np.count_nonzero((letters >= 33) & (letters <= 63) & ((letters < 48) | (letters > 57)) | (letters == 124)) / max(1, len(raw))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    share = lambda x: min(7, int(8 * x))
    steep = lambda x: min(7, int(8 * x**0.5))
    return [min(7, int(np.log2(n) / 2)), 8 + share(len(set(words)) / n ** 0.9 if n > 1 else 0), 16 + steep(again), 24 + steep(1 - len(set(lines)) / max(1, len(lines))), 32 + steep(capitals), 40 + steep(signs)]


def vector(text: str, weights: np.ndarray) -> np.ndarray:
    """Dense features of one text; the trigram part has length one, or is zero."""
    out = np.zeros(DIMENSION + BANDS, np.float32)
    part = np.sqrt(trigram_counts(text), dtype=np.float32) * weights
    out[:DIMENSION] = part / max(1e-9, float(np.linalg.norm(part)))
    out[DIMENSION + np.array(bands(text))] = BAND_WEIGHT
    return out


class Voters:
    """What tasks need to score: idf, the latent basis, the voters' unit vectors and their labels."""

    def __init__(self, weights: np.ndarray, basis: np.ndarray, vectors: np.ndarray, labels: np.ndarray) -> None:
        self.weights, self.basis, self.vectors, self.labels = weights, basis, vectors, labels

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.stack([vector(t, self.weights) for t in texts]) @ self.basis
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        near = self.embed(texts) @ self.vectors.T
        k = min(K, near.shape[1])
        best = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        last = np.take_along_axis(near, best, 1).min(axis=1, keepdims=True)
        for row in np.flatnonzero((near >= last).sum(axis=1) > k):  # ties
            above = np.flatnonzero(near[row] > last[row])
            best[row] = np.concatenate([above, np.flatnonzero(near[row] == last[row])[: k - len(above)]])
        weight = np.maximum(np.take_along_axis(near, best, 1), 1e-6).astype(np.float64) ** SHARPNESS
        return np.clip((weight * self.labels[best]).sum(1) / weight.sum(1), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> Voters:
    """``labels`` has doc_id and quality (0, 1; others don't count); conflicting labels of an id count by their mean."""
    docs = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    counts, n = latent.sum_counts(docs, "text", trigram_counts, DIMENSION)
    weights = latent.idf(counts, n)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("y"))
    many = known.count()
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / max(1, many))))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [vector(t or "", shared.value) for t in pdf["text"]]
            idx = [np.flatnonzero(r).astype(np.uint32) for r in rows]
            yield pd.DataFrame({"y": pdf["y"], "idx": [i.tobytes() for i in idx], "val": [r[i].tobytes() for r, i in zip(rows, idx, strict=True)]})

    # the sample's size is a parameter, so its ids may be broadcast
    rows = stored(docs.join(F.broadcast(chosen), "doc_id").mapInPandas(sparse, "y double, idx binary, val binary"), "voters")
    basis, _ = latent.randomised_svd(rows, DIMENSION + BANDS, RANK)
    held = docs.sparkSession.sparkContext.broadcast(basis)

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            dense = np.zeros((len(pdf), DIMENSION + BANDS), np.float32)
            for i, (idx, val) in enumerate(zip(pdf["idx"], pdf["val"], strict=True)):
                dense[i, np.frombuffer(idx, np.uint32)] = np.frombuffer(val, np.float32)
            v = dense @ held.value
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
            yield pd.DataFrame({"y": pdf["y"], "v": [x.tobytes() for x in v]})

    found = rows.mapInPandas(embed, "y double, v binary").collect()  # SAMPLE rows of RANK floats
    found.sort(key=lambda r: (bytes(r.v), r.y))
    vectors = np.array([np.frombuffer(r.v, np.float32) for r in found], np.float32).reshape(len(found), RANK)
    return Voters(weights, basis, vectors, np.array([r.y for r in found]))


def with_score(docs: DataFrame, voters: Voters, text: str = "text") -> DataFrame:
    """``docs`` plus held_out, score and predicted."""
    names = ("held_out", "score", "predicted")
    rest = without(docs, *names)
    shared = docs.sparkSession.sparkContext.broadcast(voters)
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t or "" for t in pdf[text]]
            parts = [shared.value.score(texts[i : i + BLOCK]) for i in range(0, len(texts), BLOCK)]
            yield pdf.assign(score=np.concatenate(parts) if parts else np.zeros(0))

    out = rest.mapInPandas(work, schema)
    held = bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT
    return out.withColumns({"held_out": held, "predicted": (F.col("score") >= THRESHOLD).cast("int")})
