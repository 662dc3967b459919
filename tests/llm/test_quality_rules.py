"""Statistics against plain Python, bounds against exact sums, cutoffs and verdicts."""

from __future__ import annotations

import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricefold.llm import quality_rules as q


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if threes[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = st.none() | st.lists(st.sampled_from(["a", "b", "#", " ", "\n", "\t", "é|", "\u00a0", "\x1c", "A!", "a b c ", "😀"]), max_size=60).map("".join)


@settings(max_examples=6, deadline=None)
@given(st.lists(TEXTS, min_size=30, max_size=60))
def test_statistics(spark_session, texts):
    df = spark_session.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = q.with_statistics(df).select("doc_id", *[F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]).collect()
    for r in got:
        assert tuple(r)[1:] == plain(texts[r.doc_id]), texts[r.doc_id]


def test_long_text_and_clashing_columns(spark):
    text = "word " * 60_000 + "\n" + " ".join(map(str, range(60_000)))
    df = spark.createDataFrame([(1, text, 9)], "doc_id int, text string, N_WORDS int")
    r = q.with_statistics(df).first()
    assert (r.n_words, r.n_repeat_words) == (120_000, 60_000)


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 2, 10, 100, 5000) for k in (0, 1, 2, 7, 40, n) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", q.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p"))
    for k, n, p in df.collect():
        if k > 0.02 * n:
            assert p == 1.0
            continue
        exact = sum(math.comb(n, i) * 0.02**i * 0.98 ** (n - i) for i in range(k + 1))
        assert math.isclose(p, exact, rel_tol=1e-9, abs_tol=1e-300), (k, n)


def test_cutoffs_keep_the_risk(spark):
    clean, dirty = " ".join(f"word{i}" for i in range(80)), " ".join(f"w{i}###" for i in range(80))
    rows = [(i, clean + f" x{i}", 1) for i in range(3000)] + [(10_000 + i, dirty + f" x{i}", 0) for i in range(200)]
    df = q.with_statistics(spark.createDataFrame(rows, "doc_id long, text string, quality int"))
    cutoffs = q.calibrate(df).collect()
    assert len(cutoffs) == 1 and cutoffs[0].cut_symbols == q.GRID[0]
    judged = q.judge(df, q.calibrate(df))
    assert judged.where("kept AND quality = 0").count() == 0 and judged.where("NOT kept AND quality = 1").count() == 0
    few = q.calibrate(df.where("doc_id < 50"))
    assert q.judge(df, few).where("rejected_by IS NOT NULL").count() == 0
    none = q.judge(df, q.calibrate(df.limit(0)))
    assert none.where("kept").count() == 3200
    blank = q.judge(q.with_statistics(spark.createDataFrame([(1, None), (2, " \n")], "doc_id int, text string")), q.calibrate(df))
    assert blank.where("base_failed AND NOT kept").count() == 2
