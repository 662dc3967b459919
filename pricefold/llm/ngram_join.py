"""N-gram Jaccard join by prefix trees: which documents' sets of word shingles have a Jaccard similarity of a threshold or more.

A :class:`Rule` gives the shingles' width and the threshold t, and what follows from them; the numbers below are those of
the default, three words and 0.9.

1. Equal sets become one node, so exact copies cost one row each from then on.
2. A set that links shares nine tenths of its shingles with its partner. So a node goes if more than a tenth of its
   shingles occur in no other node: first by those of a fixed part ``pool`` of the hash range, then, for what is left, by
   all. Both steps are exact and need one aggregation each.
3. The others' sets are put in a global order, rare shingles first (by the power of two of their number, then by hash).
   Two sets that link share a shingle among the first tenth of each (prefix filter). The shingles of one prefix place
   that the very same nodes share give one group: the first of them stands for all.
4. Groups go to tasks in parts of bounded size. A task stores what follows the group's shingle in each ordered set, up to
   ``SPAN`` shingles, in a trie and walks it once for each probe: partial overlaps are counted once for a whole subtree,
   and a subtree goes when its remaining lengths can't reach the needed overlap or when it belongs to the probe's own
   component. The pair is found in the group of its first common shingle, where all that comes before is known to differ.
5. There are two rounds. In the first each node goes to one place: that of the least node (leader) of most of its groups.
   A trie of whole prefixes gives each its best partner there, and the leader all of its own: two pairs a node at most,
   which join most near copies. In the second only groups that still have several components are walked, now for every
   candidate between components; rows of a group's largest component never meet each other. A link that the trie has
   counted in full joins its components at once, so further pairs between them aren't given.
6. Every other candidate is checked on its whole sets.

No link between different sets is lost and none is false (shingles are compared by 58-bit hashes, sets by a 128-bit hash
of their hashes). Defined results: a null text or one without words has an empty set, links with nothing
and is its own component, and so is a row without a doc_id; fewer words than a shingle has make one; repeated rows have
equal sets and share a component; rows that share a doc_id but not the text are judged each by its own text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import small_batches, stored
from pricefold.llm.components import connected_components

#: Sets of one trie in the second and in the first round; larger groups are split and their parts met two by two.
TRIE, FIRST = 1000, 128
#: Elements of a set that travel to a group; what follows them counts as unknown.
SPAN = 256
#: Ids that may be broadcast to fetch texts; beyond it a shuffle join does the same.
BROADCAST_IDS = 300_000
MEMO = 200_000
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words link at a Jaccard similarity of ``over`` / ``under`` or more."""

    words: int = 3
    over: int = 9
    under: int = 10

    @property
    def pool(self) -> float:
        """The part of the hash range whose shingles tell first which nodes have too much of their own: twice what they may have."""
        return min(1.0, 2 * (self.under - self.over) / self.under)

    @property
    def own_sql(self) -> str:
        """Shingles that a set of n may have beside those of its partner."""
        return f"{self.under - self.over} * n div {self.under}"

    def sizes(self, n: int, m: int) -> bool:
        return self.under * min(n, m) >= self.over * max(n, m)

    def enough(self, both: int, total: int) -> bool:
        """Whether ``both`` common shingles are enough for two sets of ``total`` shingles together."""
        return (self.under + self.over) * both >= self.over * total


RULE = Rule()


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_memo = _WordHash()


def _factor(i: int) -> np.uint64:
    return _K[i] if i < 3 else np.uint64(xxhash.xxh3_64_intdigest(b"%d" % i) | 1)


def shingles(text: str | None, width: int = RULE.words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``width`` words. ``bytes`` lower-cases and splits by ASCII alone."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_memo.__getitem__, words), np.uint64, n)
    span = min(n, width)
    h = sum((h[i : n - span + 1 + i] * _factor(i) for i in range(span)), np.uint64(n if n < width else 0))
    h = (h ^ (h >> np.uint64(31))) * _K[3]
    h = (h ^ (h >> np.uint64(29))) * _K[4]
    return np.unique(h ^ (h >> np.uint64(32)))


def digest_of(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit halves of a set's digest."""
    raw = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, content, n, hi, lo, low) of every row; low: the set's hashes in the pool. Null digests: links with nothing."""
    limit = np.uint64(min(int(rule.pool * 2**64), 2**64 - 1))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, hi, lo, low = [], [], [], []
            for text, doc_id in zip(pdf["text"], pdf["doc_id"], strict=True):
                h = shingles(text, rule.words)
                n.append(len(h))
                one, two = digest_of(h) if len(h) and doc_id == doc_id and doc_id is not None else (None, None)
                hi.append(one)
                lo.append(two)
                low.append((h[: int(np.searchsorted(h, limit))] >> np.uint64(1)).astype(np.int64))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "content": pdf["content"], "n": np.array(n, np.int64), "hi": pd.array(hi, "Int64"), "lo": pd.array(lo, "Int64"), "low": low})

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("content"))
    return stored(rows.mapInPandas(work, "doc_id long, content long, n long, hi long, lo long, low array<long>"), "signatures")


def _shared(entries: DataFrame, by: str) -> DataFrame:
    """(token, n_sets) of the tokens of more than one ``by``."""
    df = entries.groupBy("token").agg(F.min(by).alias("a"), F.max(by).alias("b"), F.count("*").alias("n_sets"))
    return df.where("a < b").select("token", "n_sets")


def _open_nodes(full: DataFrame, rule: Rule) -> DataFrame:
    """(node, hi, lo, doc_id, n) of the sets that may link: at most the rule's part of their shingles is known to be in no other set.

    Numbers are given as the table is written, so they are unique and stay as they are. Sets that agree in one half of
    their digest only would hide each other's shingles from this filter; that needs near copies with equal 64 bits."""
    entries = full.select("hi", F.explode("low").alias("token"))
    owners = entries.groupBy("token").agg(F.min("hi").alias("hi"), F.max("hi").alias("last")).where("hi = last")
    own = owners.groupBy("hi").agg(F.count("*").alias("own"))
    sizes = full.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    df = sizes.join(own, "hi", "left").where(f"coalesce(own, 0) <= {rule.own_sql}")
    return stored(df.select(F.monotonically_increasing_id().alias("node"), "hi", "lo", "doc_id", "n"), "open")


def _sets(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(node, n, tokens) of the open nodes, made again from the texts; a row for each repeated document."""
    few = nodes.count() <= BROADCAST_IDS
    wanted = nodes.select("doc_id", "node", "hi", "lo")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            node, n, tokens = [], [], []
            for text, at, *digest in zip(pdf["text"], pdf["node"].tolist(), pdf["hi"].tolist(), pdf["lo"].tolist(), strict=True):
                h = shingles(text, rule.words)
                if digest_of(h) == tuple(digest):  # a doc_id with several texts gives each node its own
                    node.append(at)
                    n.append(len(h))
                    tokens.append((h >> np.uint64(1)).astype(np.int64))
            yield pd.DataFrame({"node": np.array(node, np.int64), "n": np.array(n, np.int64), "tokens": tokens})

    rows = docs.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, "doc_id")
    return stored(rows.mapInPandas(work, "node long, n long, tokens array<long>"), "sets")


def _ordered(sets: DataFrame, rule: Rule) -> DataFrame:
    """(node, n, own, tokens): the shingles that other sets have too, in the global order; sets with too many of their own go.

    An element is the power of two of its number of sets (5 bits), then its hash (58 bits)."""
    entries = sets.select("node", "n", F.explode("tokens").alias("token"))
    power = F.floor(F.log2("n_sets")).cast("long")
    key = F.shiftleft(F.least(power, F.lit(31)), 58).bitwiseOR(F.shiftright("token", 5))
    tokens = _shared(entries, "node").select("token", key.alias("key"))
    df = entries.join(tokens, "token").groupBy("node", "n").agg(F.sort_array(F.collect_set("key")).alias("tokens"))
    return stored(df.withColumn("own", F.col("n") - F.size("tokens")).where(f"own <= {rule.own_sql}"), "ordered")


def _hash(c: str, seed: int = 0) -> Column:
    return F.xxhash64(F.col(c), F.lit(seed))


def _groups(ordered: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Each node's prefix (node, n, own, prefix), and the groups (token, lead, node, i): each group's nodes and the shingle's
    place in the node's prefix.

    Of shingles with the same nodes (by number and two 64-bit sums of hashes) the least stands for all: every pair's first
    common shingle is among those that stay."""
    prefix = stored(ordered.select("node", "n", "own", F.slice("tokens", F.lit(1), F.expr(f"int({rule.own_sql} + 1 - own)")).alias("prefix")), "prefixes")
    entries = prefix.select("node", F.posexplode("prefix").alias("i", "token"))
    groups = entries.groupBy("token").agg(F.count("*").alias("m"), F.bit_xor(_hash("node")).alias("x"), F.bit_xor(_hash("node", 1)).alias("y"), F.min("node").alias("lead")).where("m > 1")
    first = groups.groupBy("m", "x", "y").agg(F.min("token").alias("token"), F.first("lead").alias("lead")).select("token", "lead")
    return prefix, stored(entries.join(first, "token").select("token", "lead", "node", "i"), "groups")


def _linked(ordered: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """Of the pairs (a, b, sure), those that link, by their whole sets unless they are sure: what no other set has can't be common."""
    found = stored(found.groupBy("a", "b").agg(F.bool_or("sure").alias("sure")), "pairs")
    one = ordered.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("x"))
    two = ordered.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    checked = found.where("NOT sure").join(one, "a").join(two, "b").where((rule.under + rule.over) * both >= rule.over * (F.col("n_a") + F.col("n_b")))
    return stored(checked.select("a", "b").unionByName(found.where("sure").select("a", "b")), "links")


class Trie:
    """What follows a group's shingle in ordered prefixes; each trie node knows the least and greatest set size below it, the
    most elements that any of its sets still has, and their component if it is one.

    A trie node without children keeps the rest of its only prefix as a tail, so a prefix makes nodes only as far as
    others share it."""

    __slots__ = ("children", "component", "ends", "least", "most", "rest", "rule")

    def __init__(self, rule: Rule = RULE) -> None:
        self.rule = rule
        self.children: dict[int, Trie] = {}
        self.component: int | None = None
        self.least, self.most, self.rest = 1 << 60, 0, 0
        self.ends: list[tuple[list[int], int, int, int, int]] = []  # tail, node, size, elements from the group's shingle on, component

    def insert(self, suffix: list[int], node: int, n: int, place: int, component: int) -> None:
        """Stores a set of size ``n`` whose element at ``place`` is the group's shingle; ``suffix`` follows it."""
        at, tail, rest = self, suffix, n - place
        while True:
            at.component = component if at.most == 0 or at.component == component else None
            at.least, at.most, at.rest = min(at.least, n), max(at.most, n), max(at.rest, rest)
            if not tail or (not at.children and not at.ends):
                break
            if moved := next((e for e in at.ends if e[0]), None):  # a tail moves one level down to make room
                at.ends.remove(moved)
                below = at.children[moved[0][0]] = Trie(self.rule)
                below.component, below.least, below.most, below.rest = moved[4], moved[2], moved[2], moved[3]
                below.ends.append((moved[0][1:], *moved[1:]))
            if tail[0] not in at.children:
                at.children[tail[0]] = Trie(self.rule)
            at, tail = at.children[tail[0]], tail[1:]
        at.ends.append((tail, node, n, rest, component))

    def candidates(self, suffix: list[int], n: int, place: int, component: int, common: int = 1) -> Iterator[tuple[int, int, int]]:
        """(node, size, known common elements) of the stored sets of other components that may link.

        Bounds hold for pairs whose first common shingle is the group's: what comes before it differs. Whole prefixes have
        no such shingle: ``common`` is 0 and ``place`` the last one of what no other set has."""
        m, own, rule, left = len(suffix), frozenset(suffix), self.rule, n - place - 1
        last = suffix[-1] if suffix else -1
        # subtree, place in the probe's suffix, common so far, stored elements that the probe is past
        stack = [(self, 0, common, 1)]
        while stack:
            at, i, common, passed = stack.pop()
            if at.component == component:
                continue
            for tail, node, size, rest, other in at.ends:
                if other == component or not rule.sizes(n, size):
                    continue
                c, seen, below = common, i, passed
                if tail:
                    c += len(own.intersection(tail))
                    seen = max(i, bisect_right(suffix, tail[-1]))
                    below += bisect_right(tail, last)
                # all elements up to the smaller last one have been seen on both sides
                if rule.enough(c + min(left - seen, rest - below), n + size):
                    yield node, size, c
            for t, child in at.children.items():
                if rule.under * child.most < rule.over * n or rule.over * child.least > rule.under * n:
                    continue
                j = bisect_left(suffix, t, i)
                hit = j < m and suffix[j] == t
                c, j = common + hit, j + hit
                # past the probe's last element, those of the other side may still be common
                below = passed + (t <= last)
                if rule.enough(c + min(left - j, child.rest - below), n + child.least):
                    stack.append((child, j, c, below))


Row = tuple[int, int, int, int, list[int], int]  # part, node, n, place, suffix, component or leader


def best_pairs(rows: list[Row], rule: Rule) -> Iterator[tuple[int, int, bool]]:
    """First round: each node with its best partner among the smaller ones, and the leader with all of its own."""
    trie = Trie(rule)
    for _, node, n, place, prefix, lead in rows:
        best = (0, 0)
        for x, _, c in trie.candidates(prefix, n, place, node, 0):
            if lead in (x, node):
                yield min(node, x), max(node, x), False
            elif c:
                best = max(best, (c, -x))
        if best[0]:
            yield min(node, -best[1]), max(node, -best[1]), False
        trie.insert(prefix, node, n, place, node)


class _Joined:
    """Components within one group, joined as links are found."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (y := self.above.get(x, x)) != x:
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        self.above[self.top(x)] = self.top(y)


def open_pairs(rows: list[Row], rule: Rule) -> Iterator[tuple[int, int, bool]]:
    """Second round: candidates between components, of one part with itself or of two parts with each other.

    Links that are sure join their components."""
    trie, joined, parts = Trie(rule), _Joined(), {r[0] for r in rows}
    of = {r[1]: r[5] for r in rows}
    if len(parts) > 1:
        for part, node, n, place, suffix, component in rows:
            if part == max(parts):
                trie.insert(suffix, node, n, place, component)
    for part, node, n, place, suffix, component in rows:
        if len(parts) > 1 and part == max(parts):
            continue
        for x, size, common in trie.candidates(suffix, n, place, component):
            if joined.top(component) == joined.top(of[x]):
                continue
            if sure := rule.enough(common, n + size):
                joined.join(component, of[x])
            yield min(node, x), max(node, x), sure
        if len(parts) == 1:
            trie.insert(suffix, node, n, place, component)


def _walked(groups: DataFrame, walk: Callable[[list[Row], Rule], Iterator[tuple[int, int, bool]]], rule: Rule) -> DataFrame:
    """(a, b, sure) from groups (token, i, j) of rows (part, node, n, at, suffix, mark). Groups are read as runs of a sorted stream."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, rows, out = None, [], []
        columns = ("token", "i", "j", "part", "node", "n", "at", "suffix", "mark")
        for pdf in batches:
            for token, i, j, part, node, n, at, suffix, mark in zip(*[pdf[c].tolist() for c in columns], strict=True):
                if (token, i, j) != current:
                    if len(rows) > 1:
                        out += walk(rows, rule)
                    current, rows = (token, i, j), []
                rows.append((part, node, n, at, suffix.tolist(), mark))
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["a", "b", "sure"])
                out = []
        if len(rows) > 1:
            out += walk(rows, rule)
        yield pd.DataFrame(out, columns=["a", "b", "sure"])

    return groups.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "node").mapInPandas(work, "a long, b long, sure boolean")


def _first_round(prefix: DataFrame, groups: DataFrame) -> DataFrame:
    """Each node at its leader's, in parts of ``FIRST`` nodes, and the leader in each part."""
    votes = groups.where("node <> lead").groupBy("node", "lead").agg(F.count("*").alias("votes"))
    chosen = votes.groupBy("node").agg(F.max(F.struct("votes", "lead")).alias("best")).select("node", F.col("best.lead").alias("mark"))
    parts = chosen.groupBy("mark").agg(F.ceil(F.count("*") / FIRST).cast("int").alias("parts"))
    mine = chosen.join(parts, "mark").select("node", "mark", F.pmod(_hash("node", 2), F.col("parts")).cast("int").alias("i"))
    leaders = parts.select(F.col("mark").alias("node"), "mark", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    rows = mine.unionByName(leaders).join(prefix, "node")
    return rows.select(F.col("mark").alias("token"), "i", F.lit(0).alias("j"), F.lit(0).alias("part"), "node", "n", (F.col("own") - 1).alias("at"), F.slice("prefix", 1, SPAN).alias("suffix"), "mark")


def _second_round(ordered: DataFrame, groups: DataFrame, merged: DataFrame) -> DataFrame:
    """Groups of several components, in pairs of parts; parts of a group's largest component meet the other ones only."""
    df = groups.join(merged, "node", "left").select("token", "node", "i", F.coalesce("component", "node").alias("mark"))
    df = stored(df, "labelled")
    sizes = df.groupBy("token", "mark").agg(F.count("*").alias("k"))
    open_tokens = sizes.groupBy("token").agg(F.count("*").alias("components"), F.sum("k").alias("m"), F.max(F.struct("k", "mark")).alias("top")).where("components > 1")
    few = F.col("m") <= TRIE
    open_tokens = open_tokens.select(
        "token", F.col("top.mark").alias("largest"), F.when(few, 1).otherwise(F.ceil((F.col("m") - F.col("top.k")) / TRIE)).cast("int").alias("others"),
        F.when(few, 0).otherwise(F.ceil(F.col("top.k") / TRIE)).cast("int").alias("main"),
    )
    df = df.join(open_tokens, "token")
    within = (F.col("main") > 0) & (F.col("mark") == F.col("largest"))
    place = lambda c: F.pmod(_hash("node", 2), F.greatest(c, F.lit(1)))
    df = df.withColumn("part", F.when(within, F.col("others") + place("main")).otherwise(place("others")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.when(within, F.col("others")).otherwise(F.col("others") + F.col("main")) - 1))
    df = df.select("token", "node", "mark", "part", F.col("i").alias("k"), other.alias("other")).join(ordered, "node")
    return df.select(
        "token", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "n",
        (F.col("own") + F.col("k")).alias("at"), F.slice("tokens", F.col("k") + 2, F.lit(SPAN)).alias("suffix"), "mark",
    )


def link_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = RULE, content: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``; ``content``: with xxhash64 of its text too."""
    with small_batches(docs.sparkSession):
        out = _link_components(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), rule)
    return out if content else out.drop("content")


def _link_components(docs: DataFrame, rule: Rule) -> DataFrame:
    signatures = _signatures(docs, rule)
    full = signatures.where("hi IS NOT NULL")
    nodes = _open_nodes(full, rule)
    ordered = _ordered(_sets(docs, nodes, rule), rule)
    prefix, groups = _groups(ordered, rule)

    links = _linked(ordered, _walked(_first_round(prefix, groups), best_pairs, rule), rule)
    merged = connected_components(links)
    late = _linked(ordered, _walked(_second_round(ordered, groups, merged), open_pairs, rule), rule)

    final = connected_components(links.unionByName(late)) if late.take(1) else merged
    sets = full.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"))
    linked = nodes.join(final, "node").select("hi", "lo", "component")
    first = linked.join(sets, ["hi", "lo"]).groupBy("component").agg(F.min("doc_id").alias("component_id"))
    place = sets.join(linked.join(first, "component"), ["hi", "lo"], "left").select("hi", "lo", F.coalesce("component_id", "doc_id").alias("component_id"))
    columns = ["doc_id", "content", F.col("n").alias("n_shingles")]
    out = full.join(place, ["hi", "lo"]).select(*columns, "component_id")
    return out.unionByName(signatures.where("hi IS NULL").select(*columns, F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, components: DataFrame) -> DataFrame:
    """``docs`` with the smallest doc_id of each component only; ``components`` of the same rows, made with ``content``.

    Rows that repeat a doc_id and a text count as one document, rows without a doc_id stay. Rows that share an id but not
    the text are told apart: each stays if it has its own component's smallest id."""
    stay = components.where("doc_id = component_id").select("doc_id", F.col("content").alias("__content")).distinct()
    rows = docs.withColumn("__content", F.xxhash64("text"))
    kept = rows.join(stay, ["doc_id", "__content"], "left_semi").dropDuplicates(["doc_id", "__content"]).select(*docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))
