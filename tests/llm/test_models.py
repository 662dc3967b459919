"""Quality voting, language identification and the SVD they use."""

from __future__ import annotations

import random
import zlib

import numpy as np

from pricefold.llm import language_id, latent, quality_vote

SYLLABLES = {"en": "the and ing tion er of th sh wh".split(), "de": "der die und sch ein ung keit zu ß".split(), "fr": "le la que eau ment é oi aux ç".split()}


def prose(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_svd(spark):
    rng = np.random.default_rng(1)
    dense = (rng.standard_normal((60, 5)) @ rng.standard_normal((5, 40)) + 0.01 * rng.standard_normal((60, 40))).astype(np.float32)
    idx = np.arange(40, dtype=np.uint32).tobytes()
    rows = spark.createDataFrame([(bytearray(idx), bytearray(r.tobytes())) for r in dense], "idx binary, val binary").repartition(3)
    v, s = latent.randomised_svd(rows, 40, 5)
    _, exact, vt = np.linalg.svd(dense)
    assert np.allclose(s, exact[:5], rtol=1e-3)
    assert np.allclose(np.abs(np.sum(v.T * vt[:5], axis=1)), 1, atol=1e-3)
    nothing, zeros = latent.randomised_svd(rows.limit(0), 40, 5)
    assert nothing.shape == (40, 5) and not zeros.any()


def test_language(spark):
    rng = random.Random(2)
    docs = [(i, prose(lang := rng.choice(list(SYLLABLES)), rng.randint(5, 200), rng), lang) for i in range(600)]
    docs += [(1001, None, "en"), (1002, "123 !!", "de"), (1003, prose("de", 50, rng), None), (None, prose("fr", 50, rng), None), (1004, "", "en")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.fit(frame)
    got = language_id.with_language(frame, model).collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id in (1001, 1002, 1004):
            assert (r.lang_pred, r.score) == ("und", 1.0)
        elif r.doc_id == 1003:
            assert r.lang_pred == "de"
    held = [r.lang_pred == r.lang for r in got if r.held_out and r.doc_id < 1000]
    assert np.mean(held) > 0.97
    nothing = language_id.with_language(frame, language_id.fit(frame.where("lang IS NULL"))).collect()
    assert all(r.lang_pred == "und" for r in nothing)
    assert language_id.with_language(frame.limit(0), model).count() == 0


def test_quality(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(700):
        bad = rng.random() < 0.3
        text = prose("en", rng.randint(30, 200), rng)
        if bad:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "### "), (text.split()[0] + " ") * 80])
        docs.append((i, text))
        labels += [(i, int(not bad), 0)] if rng.random() < 0.8 else []
    docs += [(2000, None), (2001, ""), (None, "x"), docs[3]]
    labels += [(5, None, 0), (99_999, 1, 0), (None, 1, 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'z' AS SCORE")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    voters = quality_vote.fit(frame, known)
    got = quality_vote.with_score(frame, voters).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    want = {d: q for d, q, _ in labels}
    held = [r.predicted == want[r.doc_id] for r in got if r.held_out and want.get(r.doc_id) is not None]
    assert len(held) > 50 and np.mean(held) > 0.95
    blank = quality_vote.with_score(frame, quality_vote.fit(frame, known.limit(0))).collect()
    assert {r.score for r in blank} == {0.5}
    assert quality_vote.with_score(frame.limit(0), voters).count() == 0


def test_vote_against_brute_force(spark):
    """Scores from a loop over all voters, sorted; repeated voters make ties."""
    rng = random.Random(6)
    texts = [prose("en", rng.randint(5, 60), rng) for _ in range(80)] + ["one text"] * 40 + ["x" * 3_000_000]
    labels = [(i, i % 3 % 2) for i in range(len(texts))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    voters = quality_vote.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    for text, got in zip(texts, voters.score(texts), strict=True):
        v = quality_vote.vector(text, voters.weights) @ voters.basis
        v = v / max(np.linalg.norm(v), 1e-9)
        near = sorted(((float(np.float32(voters.vectors[i] @ v)), -i) for i in range(len(voters.labels))), reverse=True)
        top, total = 0.0, 0.0
        for cosine, i in near[: quality_vote.K]:
            weight = max(cosine, 1e-6) ** quality_vote.SHARPNESS
            top, total = top + weight * voters.labels[-i], total + weight
        kth = near[quality_vote.K - 1][0]
        if sum(abs(c - kth) < 1e-6 for c, _ in near) == 1:
            assert abs(got - top / total) < 1e-4
        assert 0 <= got <= 1
    assert len(set(voters.score(["one text"] * 3))) == 1


def test_ftrl_against_plain_loops():
    """A pass of the learner against the per-coordinate rule written out."""
    rng = np.random.default_rng(3)
    model = language_id.Ftrl(3)
    z, n = np.zeros((50, 3)), np.zeros((50, 3))
    for _ in range(60):
        idx, y = np.sort(rng.choice(50, 8, replace=False)), int(rng.integers(3))
        val = rng.random(8).astype(np.float32)
        w = np.zeros((50, 3))
        for i in range(50):
            for c in range(3):
                if abs(z[i, c]) > language_id.L1:
                    w[i, c] = -(z[i, c] - np.sign(z[i, c]) * language_id.L1) / ((language_id.BETA + n[i, c] ** 0.5) / language_id.ALPHA + language_id.L2)
        e = np.exp([sum(v * w[i, c] for i, v in zip(idx, val, strict=True)) for c in range(3)])
        for i, v in zip(idx, val, strict=True):
            for c in range(3):
                g = v * (e[c] / e.sum() - (c == y))
                z[i, c] += g - ((n[i, c] + g * g) ** 0.5 - n[i, c] ** 0.5) / language_id.ALPHA * w[i, c]
                n[i, c] += g * g
        model.learn(idx, val, y)
    assert np.allclose(model.z[:50], z, atol=1e-3) and np.allclose(model.n[:50], n, atol=1e-3)


def test_language_of_repeated_rows_long_texts_and_clashing_columns(spark):
    rng = random.Random(9)
    docs = [(i, prose(lang := rng.choice(list(SYLLABLES)), 40, rng), lang, "a") for i in range(300)]
    docs += [docs[1], docs[1], (900, prose("fr", 200_000, rng), None, "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, SCORE string")
    got = language_id.with_language(frame, language_id.fit(frame)).collect()
    assert len(got) == len(docs) and len({(r.lang_pred, r.score) for r in got if r.doc_id == 1}) == 1
    assert [r.lang_pred for r in got if r.doc_id == 900] == ["fr"] and all(isinstance(r.score, float) for r in got)


def test_held_out_texts_teach_nothing(spark):
    """Other texts of held-out documents, or of those without a language, change no other prediction."""
    rng = random.Random(12)
    docs = [(i, prose(lang := rng.choice(list(SYLLABLES)), 30, rng), lang) for i in range(300)] + [(400 + i, prose("de", 30, rng), None) for i in range(20)]
    held = lambda i, lang: lang is None or zlib.crc32(str(i).encode()) % 3 == 1
    other = [(i, "zzz qqq xxx " * 50 if held(i, lang) else t, lang) for i, t, lang in docs]
    a, b = (spark.createDataFrame(x, "doc_id long, text string, lang string") for x in (docs, other))
    seen = [{r.doc_id: (r.lang_pred, r.score) for r in language_id.with_language(a, language_id.fit(x)).collect()} for x in (a, b)]
    assert seen[0] == seen[1]
