"""Training-order materialisation: token sequences in a keyed random order, as fixed-stride binary shards.

1. Documents are encoded once and stored, with their place among the sequences of the task that encoded them.
2. Sequences get dense numbers (the task's offset plus that place). A keyed Feistel network over the next power of four,
   with cycle-walking, permutes [0, N): every sequence has a global slot, computed without any sort or state.
3. A shard is a range of ``RECORDS`` slots. Slots are range partitioned: each task gets neighbouring shards, in order, as
   blocks compressed against a few rows' ids, as blocks are small. The ranges are known beforehand, as slots are dense, so no sample of the rows is taken. A task fills
   one shard at a time, which has a fixed size, and writes it in one piece (under another name first, then renamed, so a
   repeated task does no harm). Record i of shard s is slot ``s * RECORDS + i``: reading can start at any slot.

A record is doc_id (8 bytes, signed), part (4 bytes), number of tokens (2 bytes), then ``LENGTH`` ids of 2 bytes, padded.
Little-endian throughout. A document's sequences are cut every ``LENGTH`` ids. Defined results: null and empty texts
have no sequence; a null doc_id is stored as the least 64-bit integer and read as null; repeated rows have sequences of
their own; an empty table gives no shard.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.llm.common import new_path

LENGTH, RECORDS, PAD = 256, 1 << 15, 50256
ROUNDS = 6
#: Ranges of slots that are written at once, at most.
RANGES = 20_000
NO_ID = -(1 << 63)
#: Bytes of stored ids that are compressed together; bytes of ids that blocks are compressed against, and from how many rows.
PAGE, SAMPLE, SAMPLE_ROWS = 1 << 23, 1 << 17, 32


def record_type(length: int = LENGTH) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("part", "<u4"), ("n", "<u2"), ("ids", "<u2", (length,))])


class Feistel:
    """A keyed permutation of [0, n)."""

    def __init__(self, n: int, key: bytes) -> None:
        self.n, self.half = n, max(1, ((max(2, n) - 1).bit_length() + 1) // 2)
        self.keys = [np.uint64(int.from_bytes(hashlib.blake2b(bytes([i]), key=key[:64], digest_size=8).digest(), "little")) for i in range(ROUNDS)]

    def _once(self, x: np.ndarray) -> np.ndarray:
        bits, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> bits, x & mask
        for k in self.keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((f ^ (f >> np.uint64(29))) & mask)
        return left << bits | right

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        """Slots of sequence numbers; values outside [0, n) walk on along their cycle."""
        out = self._once(numbers.astype(np.uint64))
        while len(far := np.flatnonzero(out >= np.uint64(self.n))):
            out[far] = self._once(out[far])
        return out.astype(np.int64)


_encodings: dict[tuple[str, str], tiktoken.Encoding] = {}


def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    if (path, pattern) not in _encodings:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path, pattern] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, length: int = LENGTH) -> DataFrame:
    """Stored (doc_id, ids, task, first): ids of 2 bytes; ``first`` counts the sequences before the row in its task.

    For vocabularies below 65,536 ids, read from a rank file that is installed on every machine."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, first, task = _encoding(path, pattern), 0, TaskContext.get().partitionId()
        for pdf in batches:
            ids, firsts = [], []
            for text in pdf["text"]:
                ids.append(array("H", enc.encode_ordinary(text or "")).tobytes())
                firsts.append(first)
                first += -(-len(ids[-1]) // (2 * length))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids, "task": task, "first": firsts})

    folder = new_path(docs.sparkSession, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(work, "doc_id long, ids binary, task int, first long")
    packed = {"compression": "zstd", "parquet.compression.codec.zstd.level": "10", "parquet.page.size": str(PAGE)}
    rows.write.options(**packed).parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


#: Tasks whose offsets may be broadcast (16 bytes each); beyond it a shuffle join does the same.
BROADCAST_TASKS = 1_000_000


def offsets(tokens: DataFrame, length: int = LENGTH) -> tuple[DataFrame, int]:
    """(task, start), marked for broadcast if its size allows it, and the number of sequences."""
    counts = tokens.groupBy("task").agg(F.max(F.col("first") + F.ceil(F.octet_length("ids") / (2 * length))).alias("n")).collect()
    rows, total = [], 0
    for r in sorted(counts, key=lambda r: r.task):
        rows.append((r.task, total))
        total += r.n
    starts = tokens.sparkSession.createDataFrame(rows, "task int, start long")
    return F.broadcast(starts) if len(rows) <= BROADCAST_TASKS else starts, total


def sample_of(tokens: DataFrame) -> bytes:
    """The begins of some rows' ids, ``SAMPLE`` bytes at most: what blocks are compressed against. They only save space."""
    rows = tokens.where("octet_length(ids) > 0").select(F.substring("ids", 1, SAMPLE // SAMPLE_ROWS).alias("ids")).limit(SAMPLE_ROWS).collect()
    return b"".join(r.ids for r in rows)


def against(sample: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if sample else None


def records_of(doc_ids: list, ids: list[bytes], length: int, pad: int) -> np.ndarray:
    """The records of documents that have tokens, in order."""
    sizes = np.array([len(x) // 2 for x in ids])
    parts = -(-sizes // length)
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    rows = np.zeros(int(parts.sum()), record_type(length))
    stream = np.full(len(rows) * length, pad, np.uint16)
    for at, x in zip((first * length).tolist(), ids, strict=True):
        stream[at : at + len(x) // 2] = np.frombuffer(x, "<u2")
    rows["ids"] = stream.reshape(-1, length)
    rows["doc_id"] = np.repeat(np.array([NO_ID if d is None or d != d else int(d) for d in doc_ids], np.int64), parts)
    rows["part"] = np.arange(len(rows)) - np.repeat(first, parts)
    rows["n"] = length
    rows["n"][first + parts - 1] = sizes - (parts - 1) * length
    return rows


def write_shards(tokens: DataFrame, folder: str, key: bytes, length: int = LENGTH, records: int = RECORDS, pad: int = PAD) -> DataFrame:
    """Writes the shards of :func:`encode`'s rows below ``folder``; gives (shard, path, records) of each."""
    starts, total = offsets(tokens, length)
    kind, order, sample = record_type(length), Feistel(total, key), sample_of(tokens)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=9, dict_data=against(sample))
        waiting: list[tuple] = []
        held = 0

        def blocks() -> pd.DataFrame:
            docs, ids, numbers = zip(*waiting, strict=True)
            rows = records_of(list(docs), list(ids), length, pad)
            slots = order.slots(np.repeat(np.array(numbers, np.int64), [-(-len(x) // (2 * length)) for x in ids]) + rows["part"])
            by = np.argsort(slots)
            slots = slots[by]
            shards = slots // records
            cuts = np.append(np.flatnonzero(np.append(True, shards[1:] != shards[:-1])), len(by)).tolist()
            out = [(int(shards[a]), b - a, press.compress(slots[a:b].astype("<i8").tobytes() + rows[by[a:b]].tobytes())) for a, b in zip(cuts, cuts[1:], strict=False)]
            return pd.DataFrame(out, columns=["shard", "n", "block"])

        for pdf in batches:
            for row in zip(pdf["doc_id"].tolist(), pdf["ids"], pdf["number"].tolist(), strict=True):
                if row[1]:
                    waiting.append(row)
                    held += len(row[1])
            if held >= 1 << 26:  # 64 MB
                yield blocks()
                waiting.clear()
                held = 0
        if waiting:
            yield blocks()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = fs.FileSystem.from_uri(folder)
        press, current, rows = zstandard.ZstdDecompressor(dict_data=against(sample)), -1, np.zeros(0, kind)

        def finished() -> Iterator[pd.DataFrame]:
            if current < 0:
                return
            store.create_dir(top, recursive=True)
            name = f"{top}/shard-{current:08d}.bin"
            with store.open_output_stream(mine := f"{name}.{TaskContext.get().taskAttemptId()}") as f:
                f.write(rows.tobytes())
            store.move(mine, name)
            yield pd.DataFrame({"shard": [current], "path": [f"{folder}/shard-{current:08d}.bin"], "records": [len(rows)]})

        for pdf in batches:
            for shard, n, block in zip(pdf["shard"].tolist(), pdf["n"].tolist(), pdf["block"], strict=True):
                if shard != current:
                    yield from finished()
                    current, rows = shard, np.zeros(min(records, total - shard * records), kind)
                raw = press.decompress(block)
                rows[np.frombuffer(raw, "<i8", n) - shard * records] = np.frombuffer(raw, kind, n, 8 * n)
        yield from finished()

    placed = tokens.join(starts, "task").select("doc_id", "ids", (F.col("start") + F.col("first")).alias("number"))
    blocks = placed.mapInPandas(spread, "shard long, n long, block binary")
    shards = max(1, -(-total // records))
    each = -(-shards // RANGES)
    ranges = blocks.repartitionById(-(-shards // each), F.floor(F.col("shard") / each).cast("int")).sortWithinPartitions("shard")
    return ranges.mapInPandas(write, "shard long, path string, records long")


def read_shards(spark: SparkSession, manifest: DataFrame, from_slot: int = 0, length: int = LENGTH, records: int = RECORDS) -> DataFrame:
    """(slot, shard, record, doc_id, part, n_tokens, ids_crc32, ids) from ``from_slot`` on, each shard read in sequence.

    ids has the record's tokens without padding, 2 bytes each; ids_crc32 is theirs."""
    kind = record_type(length)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard, path, n in zip(pdf["shard"], pdf["path"], pdf["records"], strict=True):
                skip = max(0, from_slot - shard * records)
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    f.seek(skip * kind.itemsize)
                    for at in range(skip, n, 4096):
                        rows = np.frombuffer(f.read(min(4096, n - at) * kind.itemsize), kind)
                        ids = [r[: 2 * k] for r, k in zip(map(np.ndarray.tobytes, rows["ids"]), rows["n"].tolist(), strict=True)]
                        number = np.arange(at, at + len(rows))
                        yield pd.DataFrame({"slot": shard * records + number, "shard": shard, "record": number, "doc_id": pd.Series(rows["doc_id"].astype("i8")).astype("Int64").mask(rows["doc_id"] == NO_ID), "part": rows["part"].astype("i8"), "n_tokens": rows["n"].astype("i8"), "ids_crc32": list(map(zlib.crc32, ids)), "ids": ids})

    return manifest.where(F.col("shard") * records + F.col("records") > from_slot).mapInPandas(work, "slot long, shard long, record long, doc_id long, part long, n_tokens long, ids_crc32 long, ids binary")
