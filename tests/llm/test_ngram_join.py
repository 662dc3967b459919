"""Components against brute force, with tiny tries and a group of near copies."""

from __future__ import annotations

import random
import re

import pytest

from pricefold.llm import ngram_join as g
from pricefold.llm.components import connected_components


def plain(docs, width=3, percent=90):
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append(frozenset([tuple(words)] if 0 < len(words) < width else [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]))
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(docs))


def corpus(rng):
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    docs = []
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60, 200, 400]))]
        if base % 3 == 0:
            words += passage
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
    docs += [None, "", "  \t", "One", "one", "one Two", "ONE two", "a b c", "a b c", "A B C", "x\x1cy z"]
    rng.shuffle(docs)
    return [(i * 3 + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("size", [4, 1000])
def test_components(spark, monkeypatch, size):
    monkeypatch.setattr(g, "TRIE", size)
    monkeypatch.setattr(g, "FIRST", 3 if size == 4 else 60)
    monkeypatch.setattr(g, "SPAN", 2 if size == 4 else 256)
    docs = corpus(random.Random(size))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in g.link_components(frame).collect()) == plain(docs)


@pytest.mark.parametrize("size", [4, 1000])
def test_five_words_and_eight_tenths(spark, monkeypatch, size):
    import corpus_pipeline

    monkeypatch.setattr(g, "TRIE", size)
    monkeypatch.setattr(g, "FIRST", 3 if size == 4 else 60)
    monkeypatch.setattr(g, "SPAN", 2 if size == 4 else 256)
    rng = random.Random(20 + size)
    docs = corpus(rng)
    text = " ".join(f"w{i}" for i in range(104))
    docs += [(9001, text), (9002, text + "".join(f" x{i}" for i in range(15))), (9003, "p q r s"), (9004, "P q r s"), (9005, "p q r")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = plain(docs, 5, 80)
    assert sorted(tuple(r) for r in g.link_components(frame, rule=corpus_pipeline.NEAR).collect()) == want
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, frame, "").collect()}
    assert kept == {c for _, _, c in want} and 9001 in kept and 9002 not in kept


def test_shuffled_fetch_and_one_of_each(spark, monkeypatch):
    monkeypatch.setattr(g, "BROADCAST_IDS", 0)
    docs = corpus(random.Random(3))
    frame = spark.createDataFrame([(*d, "x") for d in docs] + [(None, "one of none", "x"), (*docs[0], "x")], "doc_id long, text string, n string")
    found = g.link_components(frame, content=True)
    kept = g.one_of_each(frame, found)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, _, c in plain(docs)})
    assert kept.where("doc_id IS NULL").count() == 1


def grouped(prefix, token):
    """Place and what follows it of a group's shingle."""
    place = prefix.index(token)
    return prefix[place + 1 :], place


def test_trie_and_bounds_lose_nothing():
    rng = random.Random(8)
    sets = [sorted(rng.sample(range(400), 60))]
    for _ in range(150):
        sets.append(sorted((set(rng.choice(sets)) - set(rng.sample(range(400), 20))) | set(rng.sample(range(400), rng.randint(0, 3)))))
    want = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(set(sets[i]) & set(sets[j])) >= 90 * len(set(sets[i]) | set(sets[j]))}
    prefix = [s[: len(s) // 10 + 1] for s in sets]
    got = set()
    for token in {t for p in prefix for t in p}:
        trie = g.Trie()
        for i in [i for i in range(len(sets)) if token in prefix[i]]:
            suffix, place = grouped(prefix[i], token)
            found = [(x, i) for x, _, _ in trie.candidates(suffix, len(sets[i]), place, i)]
            assert len(found) == len(set(found))
            got |= {(x, y) for x, y in found if min(set(sets[x]) & set(sets[y])) == token}  # each in its own group
            trie.insert(suffix, i, len(sets[i]), place, i)
    assert want and want <= got


def test_trie_keeps_subsets():
    """A set and the set with a few more, J from 0.90 to 0.92, the additions below, among and above its hashes."""
    rng = random.Random(9)
    for k in range(400):
        n = rng.randint(30, 300)
        more = next(x for x in range(n // 9, 0, -1) if 100 * n >= 90 * (n + x))
        assert 0.9 <= n / (n + more) < 0.94
        small = sorted(rng.sample(range(1000, 2000), n))
        low, high = [(0, 1000), (1000, 2000), (2000, 3000), (0, 1100), (0, 3000)][k % 5]
        large = sorted(small + rng.sample([x for x in range(low, high) if x not in small], more))
        others = [sorted(rng.sample(range(1000, 2000), n)) for _ in range(k % 3)]
        for stored, probe in ((small, large), (large, small)):
            first = [s[: len(s) // 10 + 1] for s in (stored, probe)]
            token = min(set(first[0]) & set(first[1]))
            for cut in (300, k % 4):  # what is cut off counts as unknown
                trie = g.Trie()
                for i, s in enumerate(others):
                    trie.insert(s[: n // 10][:cut], i, len(s), k % 2, i)
                suffix, place = grouped(first[0], token)
                trie.insert(suffix[:cut], len(others), len(stored), place, len(others))
                suffix, place = grouped(first[1], token)
                assert len(others) in {x for x, _, _ in trie.candidates(suffix[:cut], len(probe), place, 99)}, (k, n, more, cut)


def test_first_round_is_linear_and_second_finds_the_rest():
    """A group of near copies: few pairs at first; then all that cross components, and none within one."""
    base = list(range(200))
    sets = [sorted(base[:i] + base[i + 1 :]) for i in range(1, 60)]
    whole = [(0, i, len(s), -1, s[: len(s) // 10 + 1], 0) for i, s in enumerate(sets)]
    first = set(g.best_pairs(whole, g.RULE))
    assert len(first) < 2 * len(whole) and {(0, i, False) for i in range(1, len(whole))} <= first
    rows = [(0, i, len(s), 0, s[1 : len(s) // 10 + 1], 0) for i, s in enumerate(sets)]
    half = [(*r[:5], r[1] % 2) for r in rows]
    assert set(g.open_pairs(half, g.RULE)) == {(i, j, False) for j in range(len(rows)) for i in range(j) if i % 2 != j % 2}
    parts = [(int(r[1] >= 30), *r[1:5], r[1]) for r in rows]
    assert set(g.open_pairs(parts, g.RULE)) == {(i, j, False) for j in range(30, len(rows)) for i in range(30)}
    known = [(0, i, len(s), 0, s[1:], i % 3) for i, s in enumerate(sets)]  # whole sets: links are sure, and two join three components
    assert [x[2] for x in g.open_pairs(known, g.RULE)] == [True, True]


def test_repeated_ids_long_texts_and_clashing_columns(spark):
    """Texts that share an id are judged each by its own; a text of 60,000 words is read whole."""
    long = " ".join(f"w{i}" for i in range(60_000))
    other = " ".join(f"u{i}" for i in range(50))
    rows = [(1, long, 5, "a"), (2, long + " more", 5, "b"), (2, other, 5, "c"), (3, other + " x", 5, "d"), (2, other, 5, "c"), (4, None, 5, "e"), (4, "", 5, "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long, node string")
    got = sorted(tuple(r) for r in g.link_components(frame).collect())
    assert got == [(1, 59_998, 1), (2, 48, 2), (2, 48, 2), (2, 59_999, 1), (3, 49, 2), (4, 0, 4), (4, 0, 4)]
    kept = g.one_of_each(frame, g.link_components(frame, content=True))
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.node) for r in kept.collect()) == [(1, "a"), (2, "c"), (4, "e"), (4, "f")]


def test_empty(spark):
    assert g.link_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_component_rounds_have_small_plans(spark, monkeypatch):
    from pricefold.llm import components

    leaves, write = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: (leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size()), write(df, name))[1])
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 9)], "a long, b long")
    assert sorted(map(tuple, connected_components(links).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (9, 5)]
    assert max(leaves) <= 4  # the driver holds and compiles each round's plan
    del leaves[:]
    assert connected_components(links.limit(0)).collect() == [] and len(leaves) == 1


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (300, 200), (300, 250)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100, 200: 200, 250: 200, 300: 200}
