"""Language-model scores: a causal self-attention model, trained in numpy over Spark's partitions on subword ids.

Words are runs without white space after lower-casing A-Z; a text's tokens are its words and one end. The base score is
the add-one unigram model over words. The model sees the words, joined by blanks, as subword ids of a public rank file (no
tokenizer is trained), then the end, and its score is the sum of log10 probabilities of those.

One layer: an embedding of each id, one causal attention head with a bias for each distance, and a softmax in two steps (one
of some classes of about equal mass, then the id within it), mixed with a small uniform share, so every score is finite. Training
goes once over all learnable texts, in rounds of growing size: each task trains its own copy with Adam, the copies are
averaged by the ids they saw (block sums in Spark; the driver sees one model). In scoring, overlapping windows of ``WINDOW``
ids are attended in batches; each id is scored once, with at least ``OVERLAP`` ids before it where the text has them.

Word counts are a table of their own. Only words of at least an ``1 / HOT`` share of all words (so ``HOT`` at most) go to
the tasks; the rest, each of few rows, are joined by a shuffle.

Defined results: a null or empty text has the end as its only token; equal texts have equal scores, but for the order of
float sums; a null id is not held out. Without learnable texts the model is uniform and the base score's N and V are 0.
Columns of the input named like a result are replaced; case doesn't count.
"""

from __future__ import annotations

import ctypes
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tiktoken.load import load_tiktoken_bpe

from pricefold.llm.common import bucket_of, small_batches, stored, without

FOLDS, HELD_OUT = 7, 2
#: Width of the model; ids that attend to each other; of those, ids that a window doesn't score again.
WIDTH, WINDOW, OVERLAP = 16, 16, 4
#: Classes of about equal mass, and ids in one of them at most; how steeply attention begins to fall with distance.
CLASSES, CLASS_SIZE, DECAY = 24, 256, 0.2
#: Share of the uniform distribution over the whole vocabulary.
UNIFORM = 1e-4
#: Rounds as shares of 128 of the texts, with their learning rates; windows in one step; ids that a task trains on at least.
ROUNDS = ((1, 0.04), (1, 0.04), (2, 0.03), (4, 0.024), (8, 0.02), (16, 0.016), (32, 0.012), (64, 0.008))
STEP, TASK = 384, 400_000
#: A small corpus is gone through more than once: until so many ids are trained on, in so many more passes at most.
LEAST, MORE, MORE_RATE = 8_000_000, 8, 0.03
HOT = 65_536
#: Distinct words that a task counts before it passes its counts on.
COUNTED = 50_000
#: Blanks and characters of one pre-token; longer words are cut.
PIECE = r" ?[^ ]{1,32}"
#: Parameters in one row of a partial sum, and tasks whose sums are added first.
PART, FAN = 4096, 64
SEED = 20240613


@lru_cache(1)
def subwords(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=PIECE, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})


@lru_cache(1)
def reuse_freed_memory() -> None:
    """Tells the C library to keep what numpy's temporaries free: asking the system anew costs more than the arithmetic."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 25)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 1 << 25)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


def give_back_freed_memory() -> None:
    """Tells the C library and Arrow to hand freed memory back: Spark keeps a worker, and what it holds, from one stage to the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def id_type(size: int) -> type[np.unsignedinteger]:
    """Of stored subword ids; those of the public rank files fit 2 bytes."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def words_in_steps(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in lists of those within about ``size`` bytes; bytes.split knows just the six white characters."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        if words := text[at:end].lower().split():
            yield words
        at = end


# ---- the model -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Ids in the model's order (by class, then count); ``place`` maps an id of the rank file to it, ``seen`` if unknown."""

    size: int  # of the rank file, with the end
    place: np.ndarray
    log_share: np.ndarray
    bounds: np.ndarray  # of classes

    @property
    def seen(self) -> int:
        return len(self.log_share)

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
        share, bounds, mass = counts[order] / max(1, counts.sum()), [0], 0.0
        for i, s in enumerate(share):
            if i > bounds[-1] and (mass + s > 1 / CLASSES or i - bounds[-1] >= CLASS_SIZE):
                bounds.append(i)
                mass = 0.0
            mass += s
        place = np.full(len(counts), len(order), np.int32)
        place[order] = np.arange(len(order))
        return cls(len(counts), place, np.log(share), np.array([*bounds, len(order)]) if len(order) else np.array([0]))


class Attention:
    """The model's parameters as views of one flat array, its forward pass and its gradient.

    Before attention, states depend on the id alone, so queries, keys and values are looked up in tables made once for each
    set of parameters; how far back an id lies enters as a bias for each distance."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None) -> None:
        v, d, c = vocabulary.seen, WIDTH, len(vocabulary.bounds) - 1
        self.vocabulary = vocabulary
        # the row after the last id is that of the text's begin, the one after that of unknown ids
        self.shapes = {"embed": (v + 2, d), "distance": (WINDOW,), "q": (d, d), "k": (d, d), "v": (d, d), "class_w": (d, c), "class_b": (c,), "out": (v, d), "out_b": (v,)}
        size = sum(int(np.prod(s)) for s in self.shapes.values())
        self.flat = np.zeros(size, np.float32) if flat is None else flat
        self.p = self.views(self.flat)
        self.class_of = np.repeat(np.arange(c, dtype=np.int16), np.diff(vocabulary.bounds))
        self.back = np.arange(WINDOW)[:, None] - np.arange(WINDOW)
        if flat is None and v:
            rng = np.random.default_rng(SEED)
            for name, scale in (("embed", 0.3), ("q", WIDTH**-0.5), ("k", WIDTH**-0.5), ("v", WIDTH**-0.5), ("class_w", 0.05), ("out", 0.05)):
                self.p[name][:] = rng.standard_normal(self.shapes[name]) * scale
            self.p["distance"][:] = -DECAY * np.arange(WINDOW)
            self.p["class_b"][:] = np.log(np.bincount(self.class_of, np.exp(vocabulary.log_share), c))
            self.p["out_b"][:] = vocabulary.log_share

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each id: its state, query, key and value side by side; and the bias of each pair of places, none of those ahead."""
        e = self.p["embed"]
        bias = np.where(self.back >= 0, self.p["distance"][np.maximum(self.back, 0)], -1e4).astype(e.dtype)
        return np.concatenate([e, e @ (self.p["q"] * WIDTH**-0.5), e @ self.p["k"], e @ self.p["v"]], axis=1), bias

    def hidden(self, ids: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """States before the output for windows of input ids (rows); padding comes last, so no earlier state sees it."""
        found = tables[0].take(ids, axis=0)
        x, q, k, v = (found[:, :, i * WIDTH : (i + 1) * WIDTH] for i in range(4))
        a = np.matmul(q, k.transpose(0, 2, 1))
        a += tables[1]
        a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a /= a @ np.ones((WINDOW, 1), a.dtype)
        return q, k, v, a, (x + np.matmul(a, v)).reshape(-1, WIDTH)

    def by_class(self, classes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first id, end, places) of the targets' classes, but for those of one id."""
        order = np.argsort(classes, kind="stable")
        bounds = self.vocabulary.bounds
        ends = np.cumsum(np.bincount(classes, minlength=len(bounds) - 1))
        for c in np.flatnonzero(np.diff(bounds) > 1):
            low, high = ends[c - 1] if c else 0, ends[c]
            if low < high:
                yield bounds[c], bounds[c + 1], order[low:high]

    @staticmethod
    def exponentials(state: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unnormalised softmax and its sums."""
        e = state @ weight
        e += bias
        e -= e.max(1, keepdims=True)
        np.exp(e, out=e)
        return e, e @ np.ones(e.shape[1], e.dtype)

    def probabilities(self, z: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target (known ids) given its state."""
        classes = self.class_of[target]
        e, total = self.exponentials(z, self.p["class_w"], self.p["class_b"])
        out = e[np.arange(len(target)), classes] / total
        for low, high, at in self.by_class(classes):
            e, total = self.exponentials(z.take(at, axis=0), self.p["out"][low:high].T, self.p["out_b"][low:high])
            out[at] *= e[np.arange(len(at)), target[at] - low] / total
        return out

    def output_gradient(self, z: np.ndarray, target: np.ndarray, g: dict[str, np.ndarray]) -> np.ndarray:
        """Adds the mean loss's gradient to ``g``; gives that of the states."""

        def step(state: np.ndarray, weight: np.ndarray, bias: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            e, total = self.exponentials(state, weight, bias)
            e *= (1 / (total * len(target)))[:, None]
            e[np.arange(len(mine)), mine] -= 1 / len(target)
            return state.T @ e, e.sum(0), e @ weight.T

        classes = self.class_of[target]
        g["class_w"][:], g["class_b"][:], back = step(z, self.p["class_w"], self.p["class_b"], classes)
        for low, high, at in self.by_class(classes):
            w, g["out_b"][low:high], more = step(z.take(at, axis=0), self.p["out"][low:high].T, self.p["out_b"][low:high], target[at] - low)
            g["out"][low:high] = w.T
            back[at] += more
        return back

    def gradient(self, ids: np.ndarray, target: np.ndarray, sel: np.ndarray) -> np.ndarray:
        """Flat gradient of the mean loss over the targets at the places ``sel``."""
        g_flat = np.zeros_like(self.flat)
        g, p, scale = self.views(g_flat), self.p, WIDTH**-0.5
        tables = self.tables()
        q, k, v, a, z = self.hidden(ids, tables)
        dz = np.zeros_like(z)
        dz[sel] = self.output_gradient(z.take(sel, axis=0), target[sel], g)
        dh = dz.reshape(q.shape)
        da = np.matmul(dh, v.transpose(0, 2, 1))
        da -= np.einsum("bij,bij->bi", da, a)[:, :, None]
        da *= a
        far = da.sum(0)
        g["distance"][:] = np.bincount(np.maximum(self.back, 0).ravel(), (far * (self.back >= 0)).ravel(), WINDOW)
        # what reaches the tables, added up for each id; from there to the embeddings and the three maps
        back = np.concatenate([dh, np.matmul(da, k), np.matmul(da.transpose(0, 2, 1), q), np.matmul(a.transpose(0, 2, 1), dh)], axis=2).reshape(-1, 4 * WIDTH)
        flat = ids.ravel().astype(np.int16 if len(p["embed"]) < 1 << 15 else np.int32)
        order = np.argsort(flat, kind="stable")
        starts = np.flatnonzero(np.diff(flat[order], prepend=-1))
        rows = flat[order[starts]]
        sums, e = np.add.reduceat(back.take(order, axis=0), starts, axis=0), p["embed"][rows]
        dx, dq, dk, dv = (sums[:, i * WIDTH : (i + 1) * WIDTH] for i in range(4))
        g["q"][:], g["k"][:], g["v"][:] = e.T @ dq * scale, e.T @ dk, e.T @ dv
        g["embed"][rows] = dx + dq @ p["q"].T * scale + dk @ p["k"].T + dv @ p["v"].T
        return g_flat


class Windows:
    """Windows of several texts' ids: inputs, targets, and which targets count (each id of a text does in one window).

    Only ``STEP`` windows are laid out at once, however long the texts are."""

    def __init__(self, texts: list[np.ndarray], vocabulary: Vocabulary, stride: int, shuffled: bool = False) -> None:
        self.shuffled = shuffled
        self.sizes, self.stride = np.array([len(t) for t in texts], np.int64), stride
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([*texts, np.zeros(WINDOW, np.int32)])
        self.prior = np.concatenate([np.zeros(1, np.int32), self.flat[:-1]])
        self.prior[self.prior == vocabulary.seen] = vocabulary.seen + 1
        self.prior[self.begins] = vocabulary.seen
        many = 1 + np.maximum(0, -((WINDOW - self.sizes) // stride))
        self.ends = np.cumsum(many)
        self.starts = self.ends - many

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def parts(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, inputs, targets, places of the targets that count) of ``STEP`` windows at a time."""
        numbers = np.random.default_rng(SEED).permutation(len(self)) if self.shuffled else np.arange(len(self))
        for i in range(0, len(self), STEP):
            number = numbers[i : i + STEP]
            text = np.searchsorted(self.ends, number, side="right")
            turn = number - self.starts[text]
            offset = (turn * self.stride)[:, None] + np.arange(WINDOW)
            places = self.begins[text][:, None] + offset
            inside = offset < self.sizes[text][:, None]
            counts = inside & ((np.arange(WINDOW) >= WINDOW - self.stride) | (turn == 0)[:, None])
            places = np.minimum(places, len(self.flat) - 1)
            yield text, self.prior[places], self.flat[places].ravel(), np.flatnonzero(counts)


def text_scores(model: Attention, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probabilities of texts, given as places in the vocabulary."""
    voc, out, tables = model.vocabulary, np.zeros(len(texts)), model.tables()
    for text, inputs, targets, sel in Windows(texts, voc, WINDOW - OVERLAP).parts():
        target = targets[sel]
        known = target < voc.seen
        p = np.full(len(sel), (UNIFORM if voc.seen else 1.0) / voc.size)
        if known.any():
            z = model.hidden(inputs, tables)[-1].take(sel[known], axis=0)
            p[known] += (1 - UNIFORM) * model.probabilities(z, target[known])
        out += np.bincount(text[sel // WINDOW], np.log10(p), len(texts))
    return out


class Trainer:
    """Adam on one copy of the model, window by window as they come."""

    def __init__(self, model: Attention, rate: float) -> None:
        self.model, self.rate, self.steps, self.ids, self.norm = model, rate, 0, 0, 0.0
        self.m, self.v = np.zeros_like(model.flat), np.zeros_like(model.flat)

    def learn(self, texts: list[np.ndarray]) -> None:
        for _, inputs, targets, sel in Windows(texts, self.model.vocabulary, WINDOW, shuffled=True).parts():
            g = self.model.gradient(inputs, targets, sel)
            norm = float(np.sqrt(g @ g))
            self.norm = norm if not self.steps else 0.95 * self.norm + 0.05 * min(norm, 2 * self.norm)
            g *= min(1.0, 2 * self.norm / max(norm, 1e-12))  # a gradient far larger than those before is an outlier
            self.steps += 1
            self.ids += len(sel)
            self.m += 0.1 * (g - self.m)
            g *= g
            self.v += 0.02 * (g - self.v)
            scale = self.rate / (1 - 0.9**self.steps)
            self.model.flat -= scale * self.m / (np.sqrt(self.v / (1 - 0.98**self.steps)) + 1e-6)


# ---- over Spark ----------------------------------------------------------------------------------------------------


def count_words(docs: DataFrame) -> DataFrame:
    """word, c, total: how often each word occurs in learnable texts and in all (columns held_out, text), stored.

    Tasks count ``COUNTED`` distinct words at a time, Spark adds the counts up."""

    def counted(learnt: Counter, held: Counter) -> pd.DataFrame:
        words = list(learnt.keys() | held.keys())
        return pd.DataFrame({"word": pd.Series([w.decode("utf-8", "replace") for w in words], dtype=object), "c": [learnt[w] for w in words], "total": [learnt[w] + held[w] for w in words]})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learnt, held = Counter(), Counter()
        for pdf in batches:
            for text, out in zip(pdf["t"], pdf["held_out"], strict=True):
                for words in words_in_steps(text or b""):
                    (held if out else learnt).update(words)
                    if len(learnt) + len(held) > COUNTED:
                        yield counted(learnt, held)
                        learnt, held = Counter(), Counter()
            give_back_freed_memory()
        yield counted(learnt, held)

    with small_batches(docs.sparkSession, 100):
        rows = docs.select("held_out", F.col("text").cast("binary").alias("t")).mapInPandas(work, "word string, c long, total long")
    return stored(rows.groupBy("word").agg(F.sum("c").alias("c"), F.sum("total").alias("total")), "words")


TOKENS = "held_out boolean, n_tokens long, n_known long, common_score double, rare array<string>, n_ids long, ids binary"


def tokenised(docs: DataFrame, rank_file: str, common: dict[bytes, float], unknown: float) -> DataFrame:
    """Rows of ``docs`` without text, with the common words' part of the base score, the rare words, and the subword ids.

    ``common`` has the log10 probability of each common word and, at the empty word, of the end; ``unknown`` that of a
    word that no learnable text has."""
    names = [f.split()[0] for f in TOKENS.split(", ")]
    rest = without(docs.withColumn("__text", F.col("text").cast("binary")), "text", *names[1:])
    schema = T.StructType([f for f in rest.schema.fields if f.name not in ("__text", "held_out")] + T.StructType.fromDDL(TOKENS).fields)
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, known = subwords(rank_file), shared.value
        kind = id_type(encoding.n_vocab + 1)
        end = np.array([encoding.n_vocab], kind)
        for pdf in batches:
            out = []
            for text in pdf.pop("__text"):
                n, n_known, score, rare, ids = 1, int(known[b""] > unknown), known[b""], [], []
                for words in words_in_steps(text or b""):
                    values = list(map(known.get, words))
                    found = np.array([v for v in values if v is not None])
                    if len(found) < len(words):
                        rare += [w.decode("utf-8", "replace") for w, v in zip(words, values, strict=True) if v is None]
                    score += float(found.sum())
                    n_known += int((found > unknown).sum())
                    n += len(words)
                    ids.append(encoding.encode_to_numpy(" " + b" ".join(words).decode("utf-8", "replace"), disallowed_special=()).astype(kind))
                ids = np.concatenate([*ids, end])
                out.append((n, n_known, score, rare, len(ids), ids.tobytes()))
            give_back_freed_memory()
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(out, columns=names[1:])], axis=1)[schema.names]

    with small_batches(docs.sparkSession, 100):
        return rest.mapInPandas(work, schema)


def id_counts(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each subword id occurs in learnable texts. Ids travel in small batches: with Spark's 10,000 rows they took hundreds of MB in a task."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, kind = np.zeros(size, np.int64), id_type(size)
        for pdf in batches:
            for x in pdf["ids"]:
                total += np.bincount(np.frombuffer(x, kind), minlength=size)
        at = np.flatnonzero(total)
        give_back_freed_memory()
        yield pd.DataFrame({"i": at, "n": total[at]})

    with small_batches(tokens.sparkSession, 100):
        rows = tokens.where("NOT held_out").select("ids").mapInPandas(work, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()  # size rows at most
    out = np.zeros(size, np.int64)
    out[rows["i"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def trained(tokens: DataFrame, vocabulary: Vocabulary) -> Attention:
    """The model after all rounds; ``tokens`` has held_out, round, n_ids and ids."""
    model, spark = Attention(vocabulary), tokens.sparkSession
    learnable = tokens.where("NOT held_out")
    sizes = {r["round"]: r["n"] for r in learnable.groupBy("round").agg(F.sum("n_ids").alias("n")).collect()}
    total = sum(sizes.values())
    more = min(MORE, LEAST // total) if total else 0
    for k, rate in [*[(None, MORE_RATE)] * more, *[(k, rate) for k, (_, rate) in enumerate(ROUNDS)]]:
        part = (learnable if k is None else learnable.where(F.col("round") == k)).select("ids")
        tasks = -(-(total if k is None else sizes.get(k, 0)) // TASK)
        if not tasks:
            continue
        if tasks <= 4 * spark.sparkContext.defaultParallelism:  # too little for a copy in each task of the scan
            part = part.repartition(tasks)
        model = Attention(vocabulary, averaged(part, model, rate))
    return model


def averaged(part: DataFrame, model: Attention, rate: float) -> np.ndarray:
    """Parameters after a round: the mean over tasks, by the ids they trained on. Sums go through two levels of groups."""
    shared = part.sparkSession.sparkContext.broadcast((model.vocabulary, model.flat))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reuse_freed_memory()
        voc, flat = shared.value
        trainer = Trainer(Attention(voc, flat.copy()), rate)
        for pdf in batches:
            trainer.learn([voc.place[np.frombuffer(x, id_type(voc.size))] for x in pdf["ids"]])
        if trainer.ids:
            starts = range(0, len(flat), PART)
            weighted = trainer.model.flat.astype(np.float64) * trainer.ids
            yield pd.DataFrame({"task": TaskContext.get().partitionId() // FAN, "at": list(starts), "ids": trainer.ids, "part": [weighted[i : i + PART].tobytes() for i in starts]})
        del trainer
        give_back_freed_memory()

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in pdf["part"])
        return pd.DataFrame({"task": [0], "at": [key[0]], "ids": [pdf["ids"].sum()], "part": [total.tobytes()]})

    schema = "task int, at int, ids long, part binary"
    with small_batches(part.sparkSession, 500):
        rows = part.mapInPandas(work, schema)
    sums = rows.groupBy("at", "task").applyInPandas(add, schema).groupBy("at").applyInPandas(add, schema).collect()  # the size of the model
    out = np.zeros_like(model.flat)
    for r in sums:
        out[r["at"] : r["at"] + PART] = np.frombuffer(r["part"]) / r["ids"]
    return out


def with_model_score(tokens: DataFrame, model: Attention) -> DataFrame:
    """``tokens`` without ids, with score."""
    rest = tokens.drop("ids", "score")
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType())])
    shared = tokens.sparkSession.sparkContext.broadcast((model.vocabulary, model.flat))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reuse_freed_memory()
        voc, flat = shared.value
        own = Attention(voc, flat)
        for pdf in batches:
            ids = [voc.place[np.frombuffer(x, id_type(voc.size))] for x in pdf.pop("ids")]
            yield pdf.assign(score=text_scores(own, ids))
            give_back_freed_memory()

    with small_batches(tokens.sparkSession, 100):
        return tokens.select(*rest.columns, "ids").mapInPandas(work, schema)


def scored(docs: DataFrame, rank_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without text, plus held_out, n_tokens, n_known, train_tokens, base_score and score."""
    names = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "common_score", "rare", "n_ids", "ids", "round", "__row")
    held = bucket_of(F.col(f"`{doc_id}`"), FOLDS) == HELD_OUT
    source = without(docs, *[n for n in names if n not in (doc_id, text)]).withColumn("held_out", held)
    source = source.withColumnRenamed(text, "text")
    words = count_words(source.select("held_out", "text"))
    n, every, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    ends = source.where("NOT held_out").count()
    n, distinct = n + ends, distinct + (ends > 0)
    value = lambda c: float(np.log10((c + 1) / (n + distinct + 1)))
    common = {r.word.encode(): value(r.c) for r in words.where(F.col("total") * HOT >= F.lit(every)).collect()}  # HOT rows at most, as totals add up to every
    common[b""] = value(ends)
    shares = np.cumsum([s for s, _ in ROUNDS])
    turn = F.pmod(F.xxhash64("ids"), F.lit(int(shares[-1])))
    number = sum(((turn >= int(s)).cast("int") for s in shares[:-1]), F.lit(0))
    tokens = tokenised(source, rank_file, common, value(0)).withColumns({"round": number, "__row": F.monotonically_increasing_id()})
    tokens = stored(tokens, "tokens")
    model = trained(tokens.select("held_out", "round", "n_ids", "ids"), Vocabulary.of(id_counts(tokens, subwords(rank_file).n_vocab + 1)))
    chance = F.log10((F.col("c") + 1) / F.lit(float(n + distinct + 1)))
    rare = tokens.select("__row", F.explode("rare").alias("word")).join(words.select("word", "c"), "word")
    rare = rare.groupBy("__row").agg(F.sum(chance).alias("rare_score"), F.count_if(F.col("c") > 0).alias("rare_known"))
    out = with_model_score(tokens.drop("rare", "round", "n_ids"), model).join(rare, "__row", "left")
    return out.withColumns({
        "n_known": F.col("n_known") + F.coalesce("rare_known", F.lit(0)), "train_tokens": F.lit(int(n)).cast("long"), "base_score": F.col("common_score") + F.coalesce("rare_score", F.lit(0.0)),
    }).drop("__row", "rare_score", "rare_known", "common_score")
