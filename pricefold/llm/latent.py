"""TF-IDF rows and their randomised SVD, computed by Spark passes over the rows.

A row is a sparse vector: ``idx`` (little-endian unsigned 32-bit) and ``val`` (32-bit floats) as binary columns. The
driver only sees matrices of ``dimension`` times ``rank + oversample``, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows made dense at once, and features in one block of a partial result.
DENSE, BLOCK = 128, 1024
OVERSAMPLE, POWER, SEED = 8, 1, 20240601


def idf(df_counts: np.ndarray, n: int) -> np.ndarray:
    """log((1 + n) / (1 + df)) + 1, as 32-bit floats."""
    return (np.log((1.0 + n) / (1.0 + df_counts)) + 1.0).astype(np.float32)


def sum_counts(docs: DataFrame, column: str, counts: Callable[[str], np.ndarray], dimension: int) -> tuple[np.ndarray, int]:
    """Over all rows: in how many texts each feature occurs, and the number of rows. ``counts`` gives a text's counts."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(dimension, np.int64), 0
        for pdf in batches:
            for text in pdf[column]:
                total += counts(text or "") > 0
                n += 1
        at = np.flatnonzero(total)
        if n:
            yield pd.DataFrame({"i": np.append(at, -1), "n": np.append(total[at], n)})

    rows = docs.select(column).mapInPandas(work, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()  # dimension + 1 rows at most
    out = np.zeros(dimension, np.int64)
    features = rows[rows.i >= 0]
    out[features.i.to_numpy()] = features.n.to_numpy()
    return out, int(rows.n[rows.i < 0].sum())


def gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A^T A Q for the matrix A of all rows: each task adds up its share, blocks of features are summed by Spark."""
    dimension, width = q.shape
    shared = rows.sparkSession.sparkContext.broadcast(q.astype(np.float32))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q32, total, seen = shared.value, np.zeros((dimension, width), np.float32), False
        for pdf in batches:
            for at in range(0, len(pdf), DENSE):
                part = pdf.iloc[at : at + DENSE]
                dense = np.zeros((len(part), dimension), np.float32)
                for i, (idx, val) in enumerate(zip(part["idx"], part["val"], strict=True)):
                    dense[i, np.frombuffer(idx, np.uint32)] = np.frombuffer(val, np.float32)
                total += dense.T @ (dense @ q32)
                seen = True
        if seen:
            blocks = range(0, dimension, BLOCK)
            yield pd.DataFrame({"block": [b // BLOCK for b in blocks], "part": [total[b : b + BLOCK].tobytes() for b in blocks]})

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf["part"])
        return pd.DataFrame({"block": [key[0]], "part": [total.tobytes()]})

    parts = rows.select("idx", "val").mapInPandas(work, "block int, part binary")
    out = np.zeros((dimension, width))
    for r in parts.groupBy("block").applyInPandas(add, "block int, part binary").collect():  # the size of q
        block = np.frombuffer(r.part).reshape(-1, width)
        out[r.block * BLOCK : r.block * BLOCK + len(block)] = block
    shared.unpersist()
    return out


def randomised_svd(rows: DataFrame, dimension: int, rank: int, oversample: int = OVERSAMPLE, power: int = POWER) -> tuple[np.ndarray, np.ndarray]:
    """(V, singular values): the leading right singular vectors as columns of a ``dimension`` x ``rank`` matrix.

    Range finder with a Gaussian start and ``power`` iterations, then Rayleigh-Ritz on what it found. No rows: zeros."""
    width = min(dimension, rank + oversample)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimension, width)))[0]
    for _ in range(1 + power):
        q = np.linalg.qr(gram_times(rows, q))[0]
    small = q.T @ gram_times(rows, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(values)[::-1][:rank]
    return (q @ vectors[:, best]).astype(np.float32), np.sqrt(np.maximum(values[best], 0))
