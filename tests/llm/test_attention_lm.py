"""The attention model: its gradient, its probabilities against plain loops, and the scores of whole tables."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from pricefold.llm import attention_lm as lm

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
UPPER = {i: i + 32 for i in range(65, 91)}


def some_model(rng, ids=40):
    counts = np.zeros(ids + 3, np.int64)
    counts[:ids] = rng.integers(1, 50, ids)
    voc = lm.Vocabulary.of(counts)
    model = lm.Attention(voc)
    model.flat = model.flat.astype(np.float64) + rng.standard_normal(len(model.flat)) * 0.2
    model.p = model.views(model.flat)
    return model


def plain_score(model, ids):
    """log10 probability of one text by loops over its ids; each sees the ids of the first window that scores it."""
    voc, p, stride, total = model.vocabulary, model.p, lm.WINDOW - lm.OVERLAP, 0.0
    before = [voc.seen, *[i if i < voc.seen else voc.seen + 1 for i in ids[:-1]]]
    classes = len(voc.bounds) - 1
    for at, target in enumerate(ids):
        turn = 0 if at < lm.WINDOW else 1 + (at - lm.WINDOW) // stride
        start = turn * stride
        q = p["embed"][before[at]] @ p["q"] / lm.WIDTH**0.5
        weights = [math.exp(q @ (p["embed"][before[j]] @ p["k"]) + p["distance"][at - j]) for j in range(start, at + 1)]
        z = p["embed"][before[at]] + sum(w * (p["embed"][before[j]] @ p["v"]) for w, j in zip(weights, range(start, at + 1), strict=True)) / sum(weights)
        chance = 0.0
        if target < voc.seen:
            c = int(np.searchsorted(voc.bounds, target, side="right")) - 1
            of_class = np.exp(z @ p["class_w"] + p["class_b"])
            inside = np.exp(p["out"][voc.bounds[c] : voc.bounds[c + 1]] @ z + p["out_b"][voc.bounds[c] : voc.bounds[c + 1]])
            chance = of_class[c] / of_class.sum() * inside[target - voc.bounds[c]] / inside.sum()
            assert classes == len(of_class)
        total += math.log10((1 - lm.UNIFORM) * chance + lm.UNIFORM / voc.size)
    return total


def test_scores_against_plain_loops(monkeypatch):
    monkeypatch.setattr(lm, "STEP", 3)
    rng = np.random.default_rng(2)
    model = some_model(rng)
    texts = [rng.integers(0, 42, n).astype(np.int32) for n in (1, 2, 15, 16, 17, 28, 29, 100)]
    got = lm.text_scores(model, texts)
    assert np.allclose(got, [plain_score(model, t) for t in texts], rtol=1e-9)
    voc, begin = model.vocabulary, np.array([7, 1, 40], np.int32)
    after = lambda i: lm.text_scores(model, [np.append(begin, i).astype(np.int32)])[0] - lm.text_scores(model, [begin])[0]
    assert abs(sum(10 ** after(i) for i in range(voc.seen)) + 10 ** after(voc.seen) * (voc.size - voc.seen) - 1) < 1e-9  # a distribution over the whole vocabulary


def test_gradient():
    rng = np.random.default_rng(5)
    model = some_model(rng)
    _, inputs, targets, sel = next(lm.Windows([rng.integers(0, 40, n).astype(np.int32) for n in (5, 50)], model.vocabulary, lm.WINDOW).parts())
    loss = lambda: -np.log(model.probabilities(model.hidden(inputs, model.tables())[-1][sel], targets[sel])).mean()
    g = model.gradient(inputs, targets, sel)
    for i in rng.choice(len(g), 60, replace=False):
        kept = model.flat[i]
        model.flat[i] = kept + 1e-6
        up = loss()
        model.flat[i] = kept - 1e-6
        assert abs((up - loss()) / 2e-6 - g[i]) < 1e-5
        model.flat[i] = kept


def test_words_in_steps():
    text = "A b\tÉc\x0b\x0cd \r\n".encode() * 50 + b"x" * 1000
    for size in (1, 7, 64, 10_000):
        assert [w for part in lm.words_in_steps(text, size) for w in part] == text.lower().split()


def plain_base(docs):
    words = {k: (t or "").translate(UPPER).replace("\x0b", " ").replace("\x0c", " ") for k, (_, t) in enumerate(docs)}
    words = {k: [w for w in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w] + [None] for k, t in words.items()}
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    c = Counter(w for k, ws in words.items() if not held[k] for w in ws)
    n, v = c.total(), len(c)
    return [(d, held[k], len(words[k]), sum(c[w] > 0 for w in words[k]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words[k])) for k, (d, _) in enumerate(docs)]


@pytest.mark.parametrize("hot", [4, lm.HOT])
def test_table(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT", hot)
    monkeypatch.setattr(lm, "LEAST", 600_000)
    monkeypatch.setattr(lm, "COUNTED", 50)
    rng = random.Random(1)
    syllables = "the and ing tion er of th sh wh É ß".split()
    prose = lambda n: rng.choice([" ", "\n", " \t"]).join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))
    docs = [(i, prose(rng.randint(1, 300))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, " \t\x0b\x0c\r\n"), (None, prose(40)), docs[4], docs[4], (1003, prose(60_000)), (1004, "x" * 200_000), (1005, "\x00\x1f\x85 日本 " * 50)]
    frame = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, SCORE string").repartition(3)
    got = lm.scored(frame, FILE).collect()
    assert set(got[0].asDict()) == {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}
    key = lambda r: (r[0] is not None, r[0] or 0)
    for r, want in zip(sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key), sorted(plain_base(docs), key=key), strict=True):
        assert r[:5] == want[:5] and abs(r[5] - want[5]) < 1e-6 * max(1, abs(want[5])) and -math.inf < r[6] < 0
    if hot == 4:  # what is learnt carries over to held-out texts
        monkeypatch.setattr(lm, "MORE", 0)
        monkeypatch.setattr(lm, "ROUNDS", [(s, 0.0) for s, _ in lm.ROUNDS])
        untrained = {r.doc_id: r.score for r in lm.scored(frame, FILE).collect()}
        gain = [r.score - untrained[r.doc_id] for r in got if r.held_out and r.n_tokens > 50]
        assert len(gain) > 20 and min(gain) > 0
    assert len({round(r.score, 2) for r in got if r.doc_id == 4}) == 1
    assert lm.scored(frame.limit(0), FILE).count() == 0


def test_nothing_learnable(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.scored(spark.createDataFrame([(held, "one two")], "doc_id long, text string"), FILE).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and abs(r.score + 3 * math.log10(50257)) < 1e-6


def test_ids_travel_in_small_batches(spark, monkeypatch):
    """Every Python task gets few rows at once, that which counts ids too, and ids take 2 bytes each."""
    taken, stores, store, frame = [], [], lm.stored, type(spark.range(1))
    plain = frame.mapInPandas
    monkeypatch.setattr(frame, "mapInPandas", lambda self, *a, **b: (taken.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))), plain(self, *a, **b))[1])
    monkeypatch.setattr(lm, "stored", lambda df, name: (stores.append(store(df, name)), stores[-1])[1])
    monkeypatch.setattr(lm, "MORE", 0)
    lm.scored(spark.createDataFrame([(i, f"some words of text {i}") for i in range(20)], "doc_id long, text string"), FILE).count()
    assert len(taken) >= 4 and max(taken) <= 500
    assert [r for r in stores[-1].collect() if len(r.ids) != 2 * r.n_ids] == []
    assert lm.id_type(1 << 16) is np.uint16 and lm.id_type((1 << 16) + 1) is np.uint32
