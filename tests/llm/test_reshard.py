"""Minimum-cost flow against the known optimum; shards, slots and rewriting."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricefold.llm import reshard as r
from pricefold.llm.common import new_path


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8), st.integers(1, 9))
def test_fewest_bytes(sizes, shards):
    shards = max(shards, len(sizes))
    total = sum(sizes)
    room = [total // shards + (j < total % shards) for j in range(shards)]
    sizes += [0] * (shards - len(sizes))
    flow = r.cheapest_transfers(sizes, room)
    for i in range(shards):
        assert sum(v for (a, _), v in flow.items() if a == i) == sizes[i]
        assert sum(v for (_, b), v in flow.items() if b == i) == room[i]
    # what exceeds a shard's new capacity has to move, and nothing else
    assert sum(v for (a, b), v in flow.items() if a != b) == sum(max(0, s - c) for s, c in zip(sizes, room, strict=True))


def documents(rng):
    hot = "the same text " * 20
    docs = [(i, hot if i % 3 == 0 else "w" * rng.randint(0, 400) + str(i), rng.choice(["a", "a", "b", None])) for i in range(3000)]
    return docs + [(5000, None, "c"), (5001, "", "c"), (5002, "é" * 50, "c"), (5002, "é" * 50, "c"), (None, "x", None)]


def test_shards(spark):
    docs = documents(random.Random(1))
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("SHARD", F.lit("old"))
    rows = r.reshard(frame, F.crc32(F.col("source")) % 16, buckets=64).collect()
    assert len(rows) == len(docs)
    size = lambda t: len((t or "").encode()) + 8
    assert Counter((x.doc_id, x.size, x.text_crc32) for x in rows) == Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t, _ in docs)
    slots, weight = defaultdict(list), Counter()
    for x in rows:
        slots[x.shard].append(x.slot)
        weight[x.shard] += x.size
        assert x.law == "bytes" and x.grown_shard is None
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(weight.values()) / 24
    assert all(abs(w - mean) < 0.05 * mean for w in weight.values())


def test_equal_texts_stay_together(spark):
    """Across old shards, whatever the table's size; only a group above an eighth of a shard is split."""
    rng = random.Random(3)
    for n in (300, 4000):
        texts = ["t" * rng.randint(1, 300) + str(i) for i in range(n // 3)]
        docs = [(i, rng.choice(texts), i % 5) for i in range(n)]
        frame = spark.createDataFrame(docs, "doc_id long, text string, old int")
        rows = r.reshard(frame, F.col("old"), buckets=16).collect()
        homes, weight = defaultdict(set), Counter()
        for x in rows:
            homes[docs[x.doc_id][1]].add(x.shard)
            weight[x.shard] += x.size
        group = Counter()
        for _, t, _ in docs:
            group[t] += len(t) + 8
        cap = sum(weight.values()) / 24
        small = [t for t, b in group.items() if b <= cap / 8]
        assert len(small) > 20 and all(len(homes[t]) == 1 for t in small)
        assert max(weight.values()) - min(weight.values()) < 0.2 * cap if n > 1000 else True


def test_large_blocks_keep_sizes_near_equal():
    rng = random.Random(4)
    blocks = [((0, i), i % 6, rng.randint(1, 100)) for i in range(3000)] + [((1, i), 2, 700) for i in range(9)]
    out = r.deal_blocks(blocks, 24, 100)
    weight = Counter()
    for key, _, size in blocks:
        weight[out[key]] += size
    mean = sum(weight.values()) / 24
    assert len(weight) == 24 and all(abs(w - mean) < 0.05 * mean for w in weight.values())
    assert r.deal_blocks([((0,), 0, 50), ((1,), 0, 50)], 3, 10).keys() == {(0,), (1,)}


def test_rewrites_affected_shards(spark):
    """Shards that lose or gain nothing are not written."""
    docs = [(i, f"{i:090d}", 0 if i < 200 else i % 2 + 2) for i in range(600)]
    docs = [(d, t, 1 if d < 20 else s) for d, t, s in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string, old int")
    folder = new_path(spark, "new")
    rows = r.resharded(frame, F.col("old"), 4, folder=folder).collect()
    back = spark.read.parquet(folder)
    assert {x.shard for x in rows} == {0, 1, 2, 3} and len(rows) == 600 and Counter(x.old_shard for x in rows) == Counter(s for _, _, s in docs)
    assert {(x.doc_id, x.text, x.shard, x.slot) for x in back.collect()} == {(x.doc_id, docs[x.doc_id][1], x.shard, x.slot) for x in rows}
    quarters = spark.createDataFrame([(i, "x" * 92 + str(i % 2), i % 2) for i in range(40)], "doc_id long, text string, old int")
    plan = r.plan_blocks(quarters, F.col("old"), 2)
    assert plan.affected == [] and plan.left == [0, 1]
    assert sorted((x.doc_id, x.shard) for x in r.resharded(quarters, F.col("old"), 2).collect()) == [(i, i % 2) for i in range(40)]


def test_query_reads_rewritten_shards(spark, tmp_path, monkeypatch):
    """Every row comes back from the written shards once, rows with repeated or missing ids too."""
    from pricefold.llm import queries

    docs = documents(random.Random(2)) + [(7000, "long " * 300_000, "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    folders = []
    write = r.rewrite
    monkeypatch.setattr(r, "rewrite", lambda rows, folder: folders.append(folder) or write(rows, folder))
    rows = queries.op10_reshard(spark, str(tmp_path)).collect()
    assert Counter((x.doc_id, x.text_crc32) for x in rows) == Counter((d, zlib.crc32((t or "").encode())) for d, t, _ in docs)
    slots = defaultdict(list)
    for x in rows:
        slots[x.shard].append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    (folder,) = folders
    written = Counter((x.doc_id, x.text, x.source) for x in spark.read.parquet(folder).collect())
    assert 0 < sum(written.values()) <= len(docs) and not written - Counter(docs)


def test_empty(spark):
    assert r.resharded(spark.createDataFrame([], "doc_id long, text string"), F.lit(0)).count() == 0
    assert r.reshard(spark.createDataFrame([], "doc_id long, text string"), F.lit(0)).count() == 0
