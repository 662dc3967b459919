"""Subsequences against the textbook table; verbatim and paraphrased leaks; clean documents."""

from __future__ import annotations

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pricefold.llm import decontaminate as d

RANDOM = random.Random(5)
COMMON = "the of and to in is was for on with".split()
WORDS = ["".join(RANDOM.choice("abcdefghilmnoprstu") for _ in range(RANDOM.randint(4, 9))) for _ in range(40_000)]


def prose(n, rng):
    return [rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(WORDS) for _ in range(n)]


@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert d.common_subsequence(a, b) == table[-1][-1]


def test_leaks(spark):
    rng = random.Random(11)
    items = [(i, " ".join(prose(rng.randint(15, 60), rng)) + ".") for i in range(40)] + [(90, None), (91, ""), (92, "the of and"), (0, "the of and to in is was for on with the of and")]
    docs, want = [], set()
    for k in range(240):
        words = prose(rng.randint(40, 900), rng)
        if k % 4 == 0:
            i = rng.randrange(40)
            inner = items[i][1].split()
            if k % 8 == 0:  # a paraphrase: some words replaced, case and marks changed, the end kept
                inner = [w if j >= len(inner) - 8 or rng.random() > 0.25 else rng.choice(WORDS) for j, w in enumerate(inner)]
                inner = [w.upper() + "," if rng.random() < 0.2 else w for w in inner]
            at = rng.randrange(len(words))
            words[at:at] = inner
            want.add((k, i))
        docs.append((k, " ".join(words)))
    plain = {(k, i) for k, i in want if k % 8}
    docs += [(500, None), (501, ""), (502, docs[4][1]), (None, docs[4][1])]
    plain.add((502, next(i for k, i in plain if k == 4)))
    want |= plain
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.item_id) for r in d.find_leaks(frame, bench).collect()]
    got = {x for x in rows if x[0] is not None}
    # verbatim passages and paraphrases are all found, clean documents left alone
    assert got == want
    assert len(rows) - len(got) == 1
    blocks = {(r.doc_id, r.item_id) for r in d.find_leaks(frame, bench, items=15).where("doc_id IS NOT NULL").collect()}
    assert plain <= blocks <= want
    kept = {r.doc_id for r in d.without_leaks(frame, d.find_leaks(frame, bench)).collect()}
    assert kept == {k for k, _ in docs} - {k for k, _ in got}


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.find_leaks(docs, bench).count() == 0
    assert d.find_leaks(docs.limit(0), bench).count() == 0


def test_paraphrases_exactly(spark):
    """All planted leaks, paraphrases included, and nothing else, also in blocks of 15 items."""
    rng = random.Random(11)
    items = [(i, " ".join(rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(WORDS[:4000]) for _ in range(rng.randint(15, 60))) + ".") for i in range(40)]
    items += [(90, None), (91, ""), (92, "the of and"), (0, "the of and to in is was for on with the of and")]
    docs, want = [], set()
    for k in range(240):
        words = [rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(WORDS[:4000]) for _ in range(rng.randint(40, 900))]
        if k % 4 == 0:
            i = rng.randrange(40)
            inner = items[i][1].split()
            if k % 8 == 0:
                inner = [w if j >= len(inner) - 8 or rng.random() > 0.25 else rng.choice(WORDS[:4000]) for j, w in enumerate(inner)]
                inner = [w.upper() + "," if rng.random() < 0.2 else w for w in inner]
            at = rng.randrange(len(words))
            words[at:at] = inner
            want.add((k, i))
        docs.append((k, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (d.ITEMS, 15):
        assert {(r.doc_id, r.item_id) for r in d.find_leaks(frame, bench, items=size).collect()} == want


@pytest.mark.parametrize("replaced", [0.1, 0.2, 0.3])
@pytest.mark.parametrize(("size", "leaks"), [(45, 40), (240, 120), (1600, 80)])
def test_recall(spark, replaced, size, leaks):
    """Paraphrases in a small table, with items in a fortieth to a tenth of all documents: nine of ten at least, no other."""
    rng = random.Random(41)
    items = [(i, " ".join(prose(rng.randint(20, 60), rng))) for i in range(min(40, leaks // 3 + 1) if size == 240 else 40)]
    docs, want = [], set()
    for k in range(size):
        words = prose(rng.randint(60, 300), rng)
        if k < leaks:
            i = k % (10 if size == 240 else len(items))  # ten items in twelve documents each
            inner = items[i][1].split()
            inner = [w if j >= len(inner) - 8 or rng.random() > replaced else rng.choice(WORDS) for j, w in enumerate(inner)]
            at = rng.randrange(len(words))
            words[at:at] = inner
            want.add((k, i))
        docs.append((k, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    print("recall", size, replaced, len(got & want) / len(want))
    assert got <= want and len(got) >= 0.9 * len(want)


def test_very_long_text_and_clashing_columns(spark):
    rng = random.Random(51)
    items = [(i, " ".join(prose(40, rng))) for i in range(30)]
    words = prose(1_000_000, rng)
    words[700_000:700_000] = items[7][1].split()
    docs = [(1, " ".join(words), 5), (2, " ".join(prose(50, rng)), 6)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    found = d.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 7)]
    kept = d.without_leaks(frame, found)
    assert kept.columns == frame.columns and [r.doc_id for r in kept.collect()] == [2]


def test_short_items_in_foreign_text(spark):
    """Items of 4 to 20 words among words that the benchmark lacks, wherever they stand, at two sizes of the corpus."""
    rng = random.Random(21)
    items = [(i, " ".join(prose(8 + i % 13, rng))) for i in range(26)] + [(80, "zebra quartz of lantern"), (81, "the of and")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    foreign = [f"ж{i}" for i in range(3000)]
    for size in (300, 3000):
        docs, want = [], set()
        for k in range(size):
            words = rng.choices(foreign, k=rng.randint(60, 120))
            if k < 2 * len(items):
                item_id, text = items[k % len(items)]
                at = rng.randrange(len(words))
                words[at:at] = text.split()
                want.add((k, item_id))
            docs.append((k, " ".join(words)))
        got = {(r.doc_id, r.item_id) for r in d.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
        # item 81 can also stand in another item
        assert {x for x in want if x[1] != 81} <= got and {x for x in got - want if x[1] != 81} == set()


def test_items_in_many_documents(spark):
    """An item in 5% and in 33% of the documents, with a word changed, dropped or added, or cut at an end."""
    rng = random.Random(31)
    for part in (0.05, 0.33):
        items = [(1, " ".join(prose(24, rng))), (2, " ".join(prose(12, rng))), (3, "the of and to in is was for on with the of and")]
        docs, want = [], set()
        for k in range(300):
            words = prose(rng.randint(60, 200), rng)
            if k < 300 * part:
                i = k % 2
                inner = items[i][1].split()
                at = rng.randrange(1, len(inner) - 1)
                change = k // 2 % 6
                if change == 0:
                    inner[at] = "changed"
                elif change == 1:
                    del inner[at]
                elif change == 2:
                    inner.insert(at, "added")
                elif change == 3:
                    inner = inner[1:]
                elif change == 4:
                    inner = inner[:-1]
                at = rng.randrange(len(words))
                words[at:at] = inner
                want.add((k, items[i][0]))
            docs.append((k, " ".join(words)))
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        got = {(r.doc_id, r.item_id) for r in d.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
        assert got == want


def test_short_items_of_common_words(spark):
    """An item of few words that many or all documents have is found where it stands, unless the caller leaves such items out."""
    rng = random.Random(13)
    docs = [(i, " ".join([*prose(20, rng), "so", "it", "was", "in", "the", "end", *prose(20, rng)])) for i in range(10)] + [(10, "end the in was it so"), (11, "so it was in the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "So it was, in the end."), (2, "end the")], "item_id long, text string")
    found = lambda **how: sorted((r.doc_id, r.item_id) for r in d.find_leaks(frame, bench, **how).collect())
    six = [(i, 1) for i in range(10)]
    assert found() == six  # two words, one of them in all documents, say nothing
    assert {*six, (10, 2)} <= set(found(shortest=1))
