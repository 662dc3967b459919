"""The permutation, and shards against the library's ids."""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from pricefold.llm import training_order as t
from pricefold.llm.common import new_path, stored

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation(n):
    slots = t.Feistel(n, b"key").slots(np.arange(n))
    assert sorted(slots) == list(range(n))
    if n > 100:
        assert (t.Feistel(n, b"other").slots(np.arange(n)) != slots).mean() > 0.9
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.15


@pytest.mark.parametrize("ranges", [1, 3, 20_000])
def test_shards(spark, monkeypatch, ranges):
    monkeypatch.setattr(t, "RANGES", ranges)
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [(i, f"document {i} " * (i % 50)) for i in range(200)] + [(7, None), (8, ""), (None, "no id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    tokens = t.encode(docs, PATH, P.PATTERN, length=16)
    manifest = stored(t.write_shards(tokens, new_path(spark, "shards"), b"key", length=16, records=64), "manifest")
    rows = t.read_shards(spark, manifest, length=16, records=64).collect()
    want = []
    for doc_id, text in texts:
        ids = library.encode_ordinary(text or "")
        want += [(doc_id, i // 16, ids[i : i + 16]) for i in range(0, len(ids), 16)]
    got = [(r.doc_id, r.part, np.frombuffer(r.ids, "<u2").tolist()) for r in rows]
    key = lambda x: (x[0] is not None, x)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sorted(r.slot for r in rows) == list(range(len(want)))
    assert all(r.slot == r.shard * 64 + r.record for r in rows)
    shards = -(-len(want) // 64)
    spread = t.write_shards(tokens, new_path(spark, "shards"), b"key", length=16, records=64).withColumn("p", F.spark_partition_id()).collect()
    by = sorted((r.shard, r.p, r.records) for r in spread)
    assert [x[0] for x in by] == list(range(shards)) and [x[1] for x in by] == sorted(x[1] for x in by)
    assert len({x[1] for x in by}) <= min(ranges, shards) and all(x[2] == 64 for x in by[:-1])
    later = t.read_shards(spark, manifest, from_slot=100, length=16, records=64).collect()
    assert sorted(r.slot for r in later) == list(range(100, len(want)))


def test_long_text_and_clashing_columns(spark):
    text = "one two three " * 40_000
    docs = spark.createDataFrame([(1, text, 5, "x")], "doc_id long, text string, task int, ids string")
    tokens = t.encode(docs, PATH, P.PATTERN)
    rows = t.read_shards(spark, stored(t.write_shards(tokens, new_path(spark, "shards"), b"k", records=100), "manifest"), records=100).collect()
    ids = [x for r in sorted(rows, key=lambda r: r.part) for x in np.frombuffer(r.ids, "<u2").tolist()]
    assert t._encoding(PATH, P.PATTERN).decode(ids) == text and len({r.shard for r in rows}) > 3


def test_small_blocks_take_little_space(spark, monkeypatch):
    """Blocks of a few records are compressed against other rows' ids, so many small shards cost little more than a large one."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(50)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 400))) for i in range(120)], "doc_id long, text string").repartition(2)
    tokens = t.encode(docs, PATH, P.PATTERN)
    sizes, plain = [], type(docs).mapInPandas
    monkeypatch.setattr(type(docs), "mapInPandas", lambda self, work, schema: (sizes.append(plain(self, work, schema)), sizes[-1])[1])
    manifest = stored(t.write_shards(tokens, new_path(spark, "shards"), b"k", records=16), "manifest")
    taken = sizes[0].agg(F.sum(F.octet_length("block")), F.count("*")).first()
    monkeypatch.setattr(t, "sample_of", lambda tokens: b"")
    t.write_shards(tokens, new_path(spark, "shards"), b"k", records=16)
    alone = sizes[-2].agg(F.sum(F.octet_length("block")), F.count("*")).first()
    assert taken[1] == alone[1] > 10 and taken[0] < 0.85 * alone[0]
    rows = t.read_shards(spark, manifest, records=16).collect()
    want = {r.doc_id: r.ids for r in tokens.collect()}
    got = {d: b"".join(r.ids for r in sorted((r for r in rows if r.doc_id == d), key=lambda r: r.part)) for d in want}
    assert got == want


def test_no_documents(spark):
    tokens = t.encode(spark.createDataFrame([(1, None)], "doc_id long, text string"), PATH, P.PATTERN)
    assert t.write_shards(tokens, new_path(spark, "shards"), b"k").count() == 0
