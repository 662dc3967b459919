"""Byte-level BPE encoding and decoding by a hierarchical-bitmap rank queue.

A pre-token's bytes form a doubly linked list. Each adjacent pair that is a token waits in the bucket of its rank; a
bitmap has a bit for each bucket that holds something, and a summary bitmap a bit for each non-zero word of the first.
Two find-first-set steps give the lowest rank, so a merge costs the same in a pre-token of ten bytes or of ten
megabytes; entries made stale by an earlier merge are skipped when they come up.

Encoding goes document by document inside tasks: no shuffle, no state but a bounded cache of pre-tokens. Defined
results: a null text is the empty text, which has no ids and decodes to nothing; repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.llm.common import without

#: Pre-tokens kept by a Python worker: two generations of half as many, the older one dropped when the younger is full.
CACHE = 600_000
WORD = 256


class RankQueue:
    """Buckets of list positions, one for each rank, below two levels of bitmaps: ``words``, and a summary that the merge loop holds."""

    def __init__(self, n_ranks: int) -> None:
        self.buckets: list[list[int] | None] = [None] * n_ranks
        self.words = [0] * (n_ranks // WORD + 1)
        self.bit = [1 << r % WORD for r in range(n_ranks)]


class BytePairEncoder:
    """Ranks and a splitting pattern; encodes and decodes whole texts without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = CACHE) -> None:
        self.ranks, self.tokens = ranks, [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.sizes = [len(t) for t in self.tokens]
        self.pairs = [ranks.get(bytes([a, b])) for a in range(256) for b in range(256)]
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(len(self.tokens))
        encoder, packs = self, [struct.Struct(f"<{n}I").pack for n in range(65)]

        class Cache(dict):
            older: dict[str, bytes] = {}

            def __missing__(self, piece: str) -> bytes:
                out = self.older.get(piece)
                if out is None:
                    ids = encoder.merge(piece.encode("utf-8", "replace"))
                    out = packs[len(ids)](*ids) if len(ids) <= 64 else struct.pack(f"<{len(ids)}I", *ids)
                if len(piece) <= 64:
                    if len(self) >= cache // 2:
                        self.older = dict(self)
                        self.clear()
                    self[piece] = out
                return out

        self.cache = Cache()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. The queue is empty before and after; its operations are written out for speed."""
        get = self.ranks.get
        if (whole := get(piece)) is not None:
            return [whole]
        buckets, words, bit, sizes, pairs = self.queue.buckets, self.queue.words, self.queue.bit, self.sizes, self.pairs
        n, summary = len(piece), 0
        end = list(range(1, n + 1))  # where the part that starts here ends; 0: merged into the part before
        before = list(range(-1, n))
        for i, (a, b) in enumerate(zip(piece, piece[1:], strict=False)):
            if (r := pairs[a << 8 | b]) is not None:
                if buckets[r]:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    words[w := r // WORD] |= bit[r]
                    summary |= 1 << w
        while summary:
            w = (summary & -summary).bit_length() - 1
            word = words[w]
            low = word & -word
            rank = w * WORD + low.bit_length() - 1
            if word == low:
                summary ^= 1 << w
            words[w] = word ^ low
            positions, buckets[rank] = buckets[rank], None
            size = sizes[rank]
            if len(positions) > 1:
                positions.sort()
            for k, i in enumerate(positions):
                middle = end[i]
                if not middle or middle >= n:
                    continue
                stop = end[middle]
                if stop - i != size:
                    continue  # stale: the bytes from i on are those of the rank only at its size
                end[i], end[middle], before[stop] = stop, 0, i
                again = False
                if stop < n and (r := get(piece[i : end[stop]])) is not None:
                    if buckets[r]:
                        buckets[r].append(i)
                    else:
                        buckets[r] = [i]
                        words[w := r // WORD] |= bit[r]
                        summary |= 1 << w
                    again = r < rank
                if i and (r := get(piece[(j := before[i]) : stop])) is not None:
                    if buckets[r]:
                        buckets[r].append(j)
                    else:
                        buckets[r] = [j]
                        words[w := r // WORD] |= bit[r]
                        summary |= 1 << w
                    again |= r < rank
                if again and k + 1 < len(positions):  # only with ranks that no training gives
                    buckets[rank] = (buckets[rank] or []) + positions[k + 1 :]
                    words[w := rank // WORD] |= bit[rank]
                    summary |= 1 << w
                    break
        out, i, ranks = [], 0, self.ranks
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.cache.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


_encoders: dict[tuple[str, str], BytePairEncoder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token, blank, rank, on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder_for(path: str, pattern: str) -> BytePairEncoder:
    """The worker's encoder for a rank file that is installed on every machine, made once."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = BytePairEncoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` without ``text``, plus n_tokens long and ids binary (and decoded binary if asked for)."""
    names = ["n_tokens", "ids", *["decoded"] * decode]
    rest = without(docs, text, *names)
    schema = T.StructType([*rest.schema.fields, T.StructField("n_tokens", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in names[1:]]])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder_for(path, pattern)
        for pdf in batches:
            ids = [bpe.encode(t or "") for t in pdf.pop("__text")]
            pdf["n_tokens"] = [len(x) // 4 for x in ids]
            pdf["ids"] = ids
            if decode:
                pdf["decoded"] = [bpe.decode(x) for x in ids]
            yield pdf

    source = docs.withColumn("__text", F.col(f"`{text}`"))
    return source.select(*[F.col(f"`{c}`") for c in rest.columns], "__text").mapInPandas(work, schema)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``'s columns plus n_tokens, ids_sha256 and decoded_sha256: encoded, then decoded from the ids alone, in one pass."""
    rest = docs.select(*keep, docs[text].alias("__text"))
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder_for(path, pattern)
        for pdf in batches:
            n, one, two = [], [], []
            for t in pdf.pop("__text"):
                ids = bpe.encode(t or "")
                n.append(len(ids) // 4)
                one.append(hashlib.sha256(ids).hexdigest())
                two.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pdf.assign(n_tokens=n, ids_sha256=one, decoded_sha256=two)

    return rest.mapInPandas(work, schema)
