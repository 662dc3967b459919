"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pricefold.llm import byte_bpe as b

PATH = P.path("byte_bpe_50k.tiktoken")
BPE = b.encoder_for(PATH, P.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


@settings(max_examples=200)
@given(st.text(max_size=200) | st.text(alphabet="ab \n's", max_size=400))
def test_same_ids_and_round_trip(text):
    ids = BPE.encode(text)
    assert list(memoryview(ids).cast("I")) == LIBRARY.encode_ordinary(text)
    assert BPE.decode(ids) == text.encode()


def test_very_long_pre_token():
    text = "a" * 30_001 + "ab" * 20_000 + "tion" * 5_000
    assert BPE.merge(text.encode()) == LIBRARY.encode_ordinary(text)


def test_ranks_that_no_training_gives():
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"ab": 5, b"abc": 1, b"bc": 7, b"abab": 0, b"aa": 3, b"aaa": 2}
    own = b.BytePairEncoder(ranks, r"\S+|\s+")
    other = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcabcabab", "aaaaaaa", "aabcbcabaab", "cababcab" * 7):
        assert own.merge(text.encode()) == other.encode_ordinary(text)


def test_cache_starts_anew():
    small = b.BytePairEncoder(BPE.ranks, P.PATTERN, cache=3)
    text = "one two three four five one two " * 3
    assert small.encode(text) == BPE.encode(text) and len(small.cache) <= 3


def test_documents(spark):
    docs = spark.createDataFrame([(1, "Hello wörld", 5), (2, None, 6), (3, "", 7), (1, "Hello wörld", 5)], "doc_id long, text string, n_tokens int")
    got = sorted(b.digests(docs, PATH, P.PATTERN).collect())
    raw = b"".join(i.to_bytes(4, "little") for i in LIBRARY.encode_ordinary("Hello wörld"))
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in got] == [(1, len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256("Hello wörld".encode()).hexdigest())] * 2 + [(2, 0, nothing, nothing), (3, 0, nothing, nothing)]
    full = b.encode_documents(docs, PATH, P.PATTERN, decode=True)
    assert full.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert {bytes(r.decoded) for r in full.collect()} == {"Hello wörld".encode(), b""}
    assert b.digests(docs.limit(0), PATH, P.PATTERN).count() == 0
