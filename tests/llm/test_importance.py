"""Importance resampling against plain counting, with longer runs, ties, nulls and long texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from pricefold.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, how):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % how.buckets for n in range(how.low, how.high + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, how, percent, least):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(runs(x, how)[1])
    for x in target:
        t.update(runs(x, how)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + how.buckets) / ((s[b] + 1.0) * (t.total() + how.buckets))))
    out, fit = [], []
    for d, x in docs:
        words, features = runs(x, how)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, features))
        row = [d, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        out.append(row)
        if len(words) >= least:
            fit.append(row)
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2]))
    for k, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[-1] = k
    return out


@pytest.mark.parametrize("how", [importance.Features(), importance.Features(1, 3, 97), importance.Features(2, 2, 1000)])
def test_against_plain_counting(spark, monkeypatch, how):
    rng = random.Random(5)
    monkeypatch.setattr(importance, "STEP", 7)
    monkeypatch.setattr(importance, "JOINED", 300)
    word = lambda: rng.choice(["Benchmark", "été", "x1", "zZ", "don't", "日本", "a-b", "\x00", "q" * 50] + [f"t{i}" for i in range(30)])
    docs = [(i, rng.choice([" ", "\n", ", "]).join(word() for _ in range(rng.choice([0, 1, 3, 25, 60])))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, "!!! ..."), (None, docs[5][1]), docs[7], docs[7], (503, "t1 t2 " * 20_000)]
    target = ["Benchmark t1 t2 t3", None, "x1 t2 t3 zz", ""]
    frame = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, RANK string").repartition(3)
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resampled(frame, aims, how=how, percent=30)
    assert len(got.columns) == 6
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=key) == sorted(map(tuple, plain(docs, target, how, 30, 20)), key=key)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(i, "one two three " * 9) for i in range(20)], "doc_id long, text string")
    assert importance.resampled(docs.limit(0), docs).count() == 0
    got = importance.resampled(docs, docs.limit(0)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2] and len({r.weight for r in got}) == 1
