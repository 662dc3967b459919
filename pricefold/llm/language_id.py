"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three code points of the lower-cased text are hashed to ``DIMENSION`` buckets, weighed by
(1 + log count) times idf (from all learnable documents) and scaled to length one. Training is follow-the-regularised-leader with
elastic-net penalties, on ``SHARDS`` shards of a bounded, deterministic sample of ``SAMPLE`` labelled rows, whose
weights are averaged; rows of the sample kept apart set the temperature that makes scores calibrated.

Defined results: a text that is null or has no letter is ``und`` with score 1; so are all texts, with score 0, if
nothing was learned. Equal scores go to the language that sorts first.
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

DIMENSION = 1 << 14
#: Labelled rows used to fit, at most (in expectation); shards; passes; the part kept apart for the temperature.
SAMPLE, SHARDS, EPOCHS, APART = 8000, 6, 2, 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-3, 1e-3
TEMPERATURES = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
FOLDS, HELD_OUT = 3, 1
BLOCK = 256


def ngram_counts(text: str) -> np.ndarray:
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    if not len(c):
        return np.zeros(DIMENSION, np.int64)
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(31) + c[1:] * np.uint32(0x85EBCA77)
    three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(33) + c[2:] * np.uint32(0xC2B2AE3D)
    return np.bincount(np.concatenate([one, two, three]) >> np.uint32(18), minlength=DIMENSION)


def weighed(counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's vector, of length one."""
    idx = np.flatnonzero(counts)
    val = (1 + np.log(counts[idx])).astype(np.float32) * weights[idx]
    return idx, val / max(1e-9, float(np.linalg.norm(val)))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Ftrl:
    """FTRL-proximal for softmax regression; weights follow from (z, n) and are sparse under L1."""

    def __init__(self, n_classes: int) -> None:
        self.z = np.zeros((DIMENSION, n_classes), np.float32)
        self.n = np.zeros((DIMENSION, n_classes), np.float32)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)).astype(np.float32)

    def learn(self, idx: np.ndarray, val: np.ndarray, y: int) -> None:
        w = self.weights(idx)
        logits = val @ w
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[y] -= 1
        g = val[:, None] * p[None, :]
        n = self.n[idx]
        more = n + g * g
        self.z[idx] += g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[idx] = more


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray, coefficients: np.ndarray, temperature: float = 1.0) -> None:
        self.languages, self.weights, self.coefficients, self.temperature = languages, weights, coefficients, temperature

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        und = np.array([not has_letter(t) for t in texts], bool)
        if not self.languages:
            return ["und"] * len(texts), und.astype(float)
        logits = np.zeros((len(texts), len(self.languages)))
        for i, t in enumerate(texts):
            if not und[i]:
                idx, val = weighed(ngram_counts(t), self.weights)
                logits[i] = val @ self.coefficients[idx]
        p = softmax(logits / self.temperature)
        best = p.argmax(1)
        return ["und" if u else self.languages[b] for u, b in zip(und, best, strict=True)], np.where(und, 1.0, p[np.arange(len(best)), best])


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    counts, n = latent.sum_counts(known.select("text"), "text", ngram_counts, DIMENSION)
    weights = latent.idf(counts, n)
    languages = sorted(r.lang for r in known.select("lang").distinct().collect())  # one row for each language
    many = known.count()
    if not many:
        return Model([], weights, np.zeros((DIMENSION, 0), np.float32))
    place = F.xxhash64("doc_id", F.lit("fit"))
    chosen = known.where(F.pmod(place, F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / many)))
    chosen = chosen.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int")).withColumn("apart", F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(APART)) == 0)
    number, k = {x: i for i, x in enumerate(languages)}, len(languages)
    shared = spark.sparkContext.broadcast(weights)

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [weighed(ngram_counts(t), shared.value) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "shard": pdf["shard"], "apart": pdf["apart"], "y": [number[x] for x in pdf["lang"]], "idx": [i.astype(np.uint32).tobytes() for i, _ in rows], "val": [v.tobytes() for _, v in rows]})

    rows = stored(chosen.mapInPandas(sparse, "doc_id long, shard int, apart boolean, y int, idx binary, val binary"), "languages")

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "y"], kind="stable")
        model, order = Ftrl(k), np.random.default_rng(int(pdf["shard"].iloc[0])).permutation(len(pdf))
        data = [(np.frombuffer(pdf["idx"].iloc[i], np.uint32), np.frombuffer(pdf["val"].iloc[i], np.float32), int(pdf["y"].iloc[i])) for i in order]
        for _ in range(EPOCHS):
            for idx, val, y in data:
                model.learn(idx, val, y)
        return pd.DataFrame({"w": [model.weights().tobytes()]})

    learned = rows.where("NOT apart").groupBy("shard").applyInPandas(train, "w binary").collect()  # SHARDS weight matrices
    coefficients = np.zeros((DIMENSION, k), np.float32)
    if learned:
        coefficients = np.mean([np.frombuffer(r.w, np.float32).reshape(DIMENSION, k) for r in sorted(learned, key=lambda r: bytes(r.w))], axis=0)
    held = spark.sparkContext.broadcast(coefficients)

    def losses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(TEMPERATURES))
        for pdf in batches:
            for idx, val, y in zip(pdf["idx"], pdf["val"], pdf["y"], strict=True):
                logits = np.frombuffer(val, np.float32) @ held.value[np.frombuffer(idx, np.uint32)]
                total -= np.log(np.maximum(softmax(logits[None, :] / TEMPERATURES[:, None])[:, y], 1e-12))
        yield pd.DataFrame({"t": np.arange(len(TEMPERATURES)), "loss": total})

    by = rows.where("apart").mapInPandas(losses, "t int, loss double").groupBy("t").agg(F.sum("loss").alias("loss")).collect()
    best = min(by, key=lambda r: (r.loss, r.t), default=None)
    return Model(languages, weights, coefficients, float(TEMPERATURES[best.t]) if best is not None else 1.0)


def with_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus held_out, lang_pred and score."""
    rest = without(docs, "held_out", "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, names, scores = [t if isinstance(t, str) else None for t in pdf[text]], [], []
            for i in range(0, len(texts), BLOCK):
                got = shared.value.predict(texts[i : i + BLOCK])
                names += got[0]
                scores += got[1].tolist()
            yield pdf.assign(lang_pred=names, score=np.array(scores, float))

    return rest.mapInPandas(work, schema).withColumn("held_out", bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT)
