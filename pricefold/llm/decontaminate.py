"""Benchmark decontamination by latent semantic retrieval.

1. Words are compared in a normal form: letters and digits only, lower case. Document frequencies of the benchmark's
   words are counted over all documents.
2. The benchmark's passages (windows of up to ``WINDOW`` words) are TF-IDF rows; a distributed randomised SVD of them
   gives a latent space of ``RANK`` dimensions. Weights are log((1 + documents) / (1 + frequency)), so a word that all
   documents have counts nothing.
3. Words of an item in at most ``TELLING`` of all documents tell of it; where fewer than ``FEW`` do, or fewer than half of
   those in at most ``HALF`` of the documents (as for an item that leaked into many of them, or in a table of few), the
   latter tell, or else all its words. A document that hasn't enough of
   them anywhere can't leak the item by the rule in 4; that bound is exact. All windows of the others, whole texts, are
   placed in the latent space and compared with the item's passages by exact cosine products. Windows at ``COSINE`` or
   more are candidates, and so are stretches with enough telling words, whatever surrounds them.
4. A candidate's surroundings are checked word by word: longest common subsequence with the whole item, of all words and
   of the telling ones alone; the smaller share counts, so that an item's common words don't make a leak. From
   ``CERTAIN`` on it is one; from ``LIKELY`` on it is one if the item's answer (its last sentence, or its last words) is
   there too. An item with few telling words is looked for in stretches of about its own length; without any words that
   half of the documents lack, it needs ``CERTAIN``.

Work grows with the documents; the benchmark goes to tasks in blocks of ``ITEMS`` items, one pass for each block, so
what is broadcast has a fixed bound. Defined results: null or blank texts and items match nothing; an item of fewer
than ``LEAST`` words matches wherever it stands without a gap, however common its words are; one of fewer than ``shortest`` words
(``SHORTEST`` unless the caller says otherwise) only if a word of it is in at most ``HALF`` of the documents (of one or two
words: ``TELLING``); repeated rows are judged alike; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm import latent
from pricefold.llm.common import stored

WINDOW, STEP = 32, 8
RANK, COSINE = 128, 0.5
CERTAIN, LIKELY, ANSWER = 0.8, 0.5, 0.8
TELLING, HALF, FEW = 0.02, 0.5, 3
LEAST, ANSWER_WORDS = 8, 6
#: Items of fewer words are looked for only if a word of theirs is rare enough to tell of them.
SHORTEST = 4
ITEMS = 20_000
#: Words of a text that are placed at once.
PART = 1 << 14
#: ASCII characters that are neither letters, digits nor white space.
MARKS = [c for c in map(chr, range(128)) if not c.isalnum() and not c.isspace()]
_NO_MARKS = dict.fromkeys(map(ord, MARKS))


def words_of(text: str | None) -> list[str]:
    """The words in normal form. ASCII marks go from the whole text at once, others word by word where there are any."""
    text = text or ""
    if text.isascii():
        return text.translate(_NO_MARKS).lower().split()
    for c in MARKS:
        text = text.replace(c, "")
    words = text.lower().split()
    if "".join(words).isalnum():
        return words
    return [w for w in ("".join(filter(str.isalnum, w)) for w in words) if w]


def answer_of(text: str | None) -> list[str]:
    """The words of the last sentence; if that is the whole text or very short, the last ``ANSWER_WORDS`` words."""
    every = words_of(text)
    last = words_of(re.split(r"(?<=[.!?:])\s+", (text or "").strip())[-1])
    return last if 3 <= len(last) < len(every) else every[-ANSWER_WORDS:]


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel: a column of the table is one integer."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & places.get(x, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _inside(a: list[int], ids: np.ndarray) -> bool:
    """Whether ``a`` stands in a text without a gap."""
    at = np.arange(max(0, len(ids) - len(a) + 1))
    for k, w in enumerate(a):
        at = at[ids[at + k] == w]
    return len(at) > 0


def numbers_of(words: Collection[str], vocabulary: dict[str, int]) -> np.ndarray:
    """Numbers in the benchmark's vocabulary; 0: another word."""
    return np.fromiter(map(vocabulary.get, words, repeat(0)), np.int32, len(words))


class Item:
    """One item: ``tell`` are the words that tell of it, ``need`` how many of them a document must have."""

    def __init__(self, item_id: int, words: list[int], answer: list[int], frequency: np.ndarray, shortest: int) -> None:
        self.item_id, self.words, self.answer = item_id, words, answer
        self.exact = len(words) < LEAST
        self.level = 0
        half = sum(frequency[w] <= HALF for w in words)
        for self.level, limit in enumerate((TELLING, HALF, np.inf)):
            self.tell = [w for w in words if frequency[w] <= limit]
            if len(self.tell) >= FEW and (self.level or 2 * len(self.tell) >= half):
                break
        self.need = (CERTAIN if self.level == 2 else LIKELY) * len(self.tell)
        if self.exact:
            rare = min(words, key=lambda w: frequency[w])
            told = len(words) >= shortest or frequency[rare] <= (HALF if len(words) >= FEW else TELLING)
            self.tell, self.need = [rare], 1 if told else np.inf


class Index:
    """A block of the benchmark as tasks need it."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray, frequency: np.ndarray, items: list[tuple[int, list[int], list[int]]], shortest: int) -> None:
        self.vocabulary, self.idf, self.items = vocabulary, idf, items
        self.weighted = self.passages = self.owner = None
        self.judged = [Item(*x, frequency, shortest) for x in items]
        self.need = np.array([x.need for x in self.judged])
        entries = sorted((w, at, x.tell.count(w)) for at, x in enumerate(self.judged) for w in set(x.tell))
        word, self.of, self.times = (np.array(x, np.int64) for x in zip(*entries, strict=True))
        self.first = np.searchsorted(word, np.arange(len(idf) + 1))
        self.tells = self.first[1:] > self.first[:-1]
        self.marked = np.zeros(len(idf), bool)

    def possible(self, ids: np.ndarray) -> np.ndarray:
        """Places of the items of which a text has as many telling words as a leak must."""
        some = np.unique(ids[self.tells[ids]])
        if not len(some):
            return some
        n = self.first[some + 1] - self.first[some]
        at = np.repeat(self.first[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.flatnonzero(np.bincount(self.of[at], self.times[at], len(self.items)) >= self.need)

    def passage_rows(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(item's place, word numbers, unit TF-IDF values) of each passage."""
        out = []
        for at, (_, ids, _) in enumerate(self.items):
            for start in range(0, max(1, len(ids) - WINDOW // 2), WINDOW // 2):
                idx, tf = np.unique(np.array(ids[start : start + WINDOW], np.uint32), return_counts=True)
                val = (tf * self.idf[idx]).astype(np.float32)
                out.append((at, idx, val / max(1e-9, float(np.linalg.norm(val)))))
        return out

    def windows(self, ids: np.ndarray) -> np.ndarray:
        """Unit vectors of all windows of a text, one for each ``STEP`` words."""
        n = len(ids)
        steps = []
        for start in range(0, n, PART):
            part = ids[start : start + PART]
            part = np.pad(part, (0, -len(part) % STEP))  # word 0 has no weight
            steps.append(self.weighted[part].reshape(-1, STEP, self.weighted.shape[1]).sum(axis=1))
        steps = np.concatenate([*steps, np.zeros((WINDOW // STEP, self.weighted.shape[1]), self.weighted.dtype)])
        count = len(range(0, max(1, n - WINDOW + STEP), STEP))
        placed = sum(steps[k : k + count] for k in range(WINDOW // STEP))
        return placed / np.maximum(np.linalg.norm(placed, axis=1, keepdims=True), 1e-9)

    def stretches(self, item: Item, ids: np.ndarray, span: int) -> np.ndarray:
        """Where in a text a telling word stands that begins a stretch of ``span`` words with enough of them."""
        self.marked[item.tell] = True
        places = np.flatnonzero(self.marked[ids])
        self.marked[item.tell] = False
        k = int(np.ceil(item.need - 1e-9))
        last = places[k - 1 :]
        return places[: len(last)][last - places[: len(last)] < span]

    def rooms(self, item: Item, ids: np.ndarray, near: list[int]) -> Iterator[np.ndarray]:
        """Stretches of a text in which the item may stand; ``near``: starts of windows with a high cosine."""
        n = len(item.words)
        if item.level:
            slack, where = max(2, n // 4), {}
            begins = self.stretches(item, ids, n + 2 * slack)
            if not len(begins):
                return
            for i, w in enumerate(item.words):
                where.setdefault(w, []).append(i)
            starts = {p - i for p, w in zip(begins.tolist(), ids[begins].tolist(), strict=True) for i in where[w]}
            for start in sorted(starts):
                yield ids[max(0, start - slack) : max(0, start + n + slack)]
            return
        todo = sorted({*near, *self.stretches(item, ids, 2 * n + WINDOW).tolist()})
        at = 0
        while at < len(todo):
            # neighbouring places are read together, with an item's room before and after
            first = last = todo[at]
            at += 1
            while at < len(todo) and todo[at] - last <= WINDOW and todo[at] - first <= WINDOW + n:
                last = todo[at]
                at += 1
            yield ids[max(0, first - n) : last + max(WINDOW, n) + n // 2]

    def share(self, item: Item, room: list[int]) -> float:
        """Part of an item's words, and of its telling words, that a stretch of text has in order: the smaller of the two."""
        share = common_subsequence(item.tell, room) / len(item.tell)
        return share if share < LIKELY else min(share, common_subsequence(item.words, room) / len(item.words))

    def leaks(self, ids: np.ndarray) -> list[tuple[int, float, float, float]]:
        """(item_id, best cosine, share of common subsequence, share of the answer) of each leaked item."""
        out = []
        possible = self.possible(ids)
        placed = self.windows(ids) if len(possible) else None
        for place in possible.tolist():
            item = self.judged[place]
            cosines = (placed @ self.passages[slice(*np.searchsorted(self.owner, [place, place + 1]))].T).max(axis=1)
            if item.exact:
                if _inside(item.words, ids):
                    out.append((item.item_id, float(cosines.max()), 1.0, 1.0))
                continue
            best = answered = 0.0
            leaked = False
            for room in self.rooms(item, ids, (np.flatnonzero(cosines >= COSINE) * STEP).tolist()):
                room = room.tolist()
                share = self.share(item, room)
                if share < LIKELY:
                    continue
                found = common_subsequence(item.answer, room) / len(item.answer)
                leaked = leaked or share >= CERTAIN or item.level < 2 and found >= ANSWER
                best, answered = max((best, answered), (share, found))
            if leaked:
                out.append((item.item_id, float(cosines.max()), best, answered))
        return out


def _vocabulary(block: DataFrame) -> tuple[list, dict[str, int]]:
    """Items of one block, which ``ITEMS`` bounds, and the numbers of their words from 1."""
    rows = [r for r in block.collect() if words_of(r.text)]
    names = sorted({w for r in rows for w in words_of(r.text)})
    return rows, {w: i + 1 for i, w in enumerate(names)}


def _frequencies(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many documents each of the vocabulary's words occurs, over all documents, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(shared.value) + 1, np.int64), 0
        for pdf in batches:
            for text in pdf["text"]:
                total[numbers_of(set(words_of(text)), shared.value)] += 1
                n += 1
        if n:
            yield pd.DataFrame({"i": [*range(len(total)), -1], "n": [*total, n]})

    out = np.zeros(len(vocabulary) + 1, np.int64)
    n = 0
    for r in docs.select("text").mapInPandas(work, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        if r.i < 0:
            n = r.n
        else:
            out[r.i] = r.n
    return out, n


def build_index(docs: DataFrame, block: DataFrame, shortest: int = SHORTEST) -> Index | None:
    """Frequencies, latent space and passages for one block of (item_id, text)."""
    spark = docs.sparkSession
    rows, vocabulary = _vocabulary(block)
    if not rows:
        return None
    counts, n = _frequencies(docs, vocabulary)
    counts[0] = 0  # a word that the benchmark hasn't counts as a rare one
    index = Index(vocabulary, np.log((1.0 + n) / (1.0 + counts)).astype(np.float32), counts / max(1, n), [(r.item_id, [vocabulary[w] for w in words_of(r.text)], [vocabulary[w] for w in answer_of(r.text)]) for r in rows], shortest)
    passages = index.passage_rows()
    data = [(int(at), bytearray(i.tobytes()), bytearray(v.tobytes())) for at, i, v in passages]
    table = stored(spark.createDataFrame(data, "item int, idx binary, val binary").repartition(min(64, 1 + len(data) // 200)), "passages")
    width = len(vocabulary) + 1
    basis, _ = latent.randomised_svd(table, width, min(RANK, len(passages), width))
    basis[0] = 0
    index.weighted = (basis * index.idf[:, None]).astype(np.float32)
    placed = np.stack([v @ basis[i] for _, i, v in passages])
    index.passages = placed / np.maximum(np.linalg.norm(placed, axis=1, keepdims=True), 1e-9)
    index.owner = np.array([at for at, _, _ in passages])
    return index


LEAK_SCHEMA = "doc_id long, item_id long, cosine double, subsequence double, answer double"


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", items: int = ITEMS, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, item_id, cosine, subsequence, answer): the leaked items of each document, in no order."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    blocks = max(1, -(-benchmark.count() // items))
    out = spark.createDataFrame([], LEAK_SCHEMA)
    for b in range(blocks):
        index = build_index(docs, benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text"), shortest)
        if index:
            out = out.unionByName(_search(docs, index))
    return out


def _search(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = shared.value
        for pdf in batches:
            out = []
            names = [None if x is None or x != x else int(x) for x in pdf["doc_id"].tolist()]
            for name, text in zip(names, pdf["text"], strict=True):
                numbers = numbers_of(words_of(text), block.vocabulary)
                if len(numbers):
                    out += [(name, *leak) for leak in block.leaks(numbers)]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "cosine", "subsequence", "answer"])

    return docs.mapInPandas(work, LEAK_SCHEMA)


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """``docs`` that leak nothing; rows without a doc_id stay."""
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
