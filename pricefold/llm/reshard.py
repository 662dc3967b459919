"""Resharding by minimum-cost flow: from old shard sizes and new capacities, the block transfers that move the fewest bytes.

1. Equal texts form a group. A group lies in the old shard that holds most of its bytes: there it counts, and from there
   it moves as one. Groups of more than ``WHOLE`` of a new shard are the only ones that are split, by document id.
2. The rows of an old shard are dealt to ``BUCKETS`` blocks by the hash of their text; a block of more than ``LARGEST`` of
   a new shard is divided by further bits of that hash, so equal texts always share a block.
3. The driver sees block sizes only: a number of rows that shards, ``BUCKETS`` and ``LARGEST`` bound. It places blocks of
   single groups that are large, solves the flow between shards (a few hundred edges) for the rest and deals each old
   shard's blocks to the flow's targets, largest first.
4. Rows of affected shards travel once, with their texts, to the task of their block, get their slots there and are
   written; the result is read back from these files. Rows of other shards stay where they are.

Law: ``bytes``. Sizes of new shards are near equal (to within about a block). Defined results: a null text has size 8
and crc32 of the empty text, and null and empty texts are one group; a null old shard is 0; repeated rows each get a slot
of their own, in an order that doesn't matter as they are equal; an empty table gives an empty result; columns of the
input named shard, slot or like an internal one (``__``) don't count.
"""

from __future__ import annotations

import heapq

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pricefold.llm.common import new_path, stored, without

SHARDS, BUCKETS = 24, 1024
#: Parts of a new shard's capacity: blocks above the first are divided between texts, groups of equal texts above the second by id.
LARGEST, WHOLE = 1 / 64, 1 / 8
ROW_BYTES = 8


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def cheapest_transfers(sizes: list[int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Bytes to carry from old shard i to new shard j at the least total moved; i to i is free, all else costs a unit a byte.

    Successive shortest paths over the residual graph of the transport problem. Only zero- and unit-cost edges occur,
    and each augmentation empties a supply, fills a capacity or drains a flow edge."""
    left, room = list(sizes), list(capacities)
    flow: dict[tuple[int, int], int] = {}
    n, m = len(sizes), len(capacities)
    while any(left):
        # shortest distances from any remaining supply; nodes: 0..n-1 old, n..n+m-1 new
        far = [0 if x else float("inf") for x in left] + [float("inf")] * m
        back: list[int | None] = [None] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    cost = int(i != j)
                    if far[i] + cost < far[n + j]:
                        far[n + j], back[n + j], changed = far[i] + cost, i, True
                    if flow.get((i, j)) and far[n + j] - cost < far[i]:
                        far[i], back[i], changed = far[n + j] - cost, n + j, True
        end = min((n + j for j in range(m) if room[j]), key=lambda v: far[v])
        path, v = [end], end
        while back[v] is not None:
            v = back[v]
            path.append(v)
        path.reverse()
        edges = list(zip(path, path[1:], strict=False))
        much = min([left[path[0]], room[end - n], *(flow[(b, a - n)] for a, b in edges if a >= n)])
        for a, b in edges:
            key, sign = ((a, b - n), 1) if a < n else ((b, a - n), -1)
            flow[key] = flow.get(key, 0) + sign * much
        left[path[0]] -= much
        room[end - n] -= much
    return {k: v for k, v in flow.items() if v}


def deal_blocks(blocks: list[tuple], shards: int, largest: int) -> dict[tuple, int]:
    """New shard of every block (key, old shard, bytes): the flow's amounts, each block to the target with most room left.

    Blocks above ``largest`` come first: they stay if their shard has room, else they go where most is."""
    total = sum(b[2] for b in blocks)
    room = [total // shards + (j < total % shards) for j in range(shards)]
    order = sorted(blocks, key=lambda b: (-b[2], b[0]))
    out = {}
    for key, old, size in order:
        if size <= largest:
            break
        out[key] = j = old if room[old] >= size else max(range(shards), key=lambda j: (room[j], -j))
        room[j] -= size
    over = -sum(min(0, x) for x in room)  # what single blocks put above a capacity is taken off the others'
    room = [max(0, x) for x in room]
    while over:
        j = max(range(shards), key=lambda j: (room[j], -j))
        take = min(over, max(1, room[j] // 2))
        room[j] -= take
        over -= take
    sizes = [0] * shards
    for key, old, size in order:
        if key not in out:
            sizes[old] += size
    want: dict[int, list] = {}
    for (i, j), much in cheapest_transfers(sizes, room).items():
        want.setdefault(i, []).append((-much, j))
    for targets in want.values():
        heapq.heapify(targets)
    for key, old, size in order:
        if key not in out:
            left, j = heapq.heappop(want[old])
            out[key] = j
            heapq.heappush(want[old], (left + size, j))
    return out


@dataclass
class Plan:
    """Where rows go: ``groups`` (__hash, __home, __parts) of texts with a home of their own, ``blocks`` with the new shard and
    first slot of each, and the shards that lose or gain rows."""

    shards: int
    buckets: int
    groups: DataFrame
    fine: DataFrame
    blocks: DataFrame
    affected: list[int]
    left: list[int]


_KEY = ["__home", "__bucket", "__sub", "__part"]


def _rows(docs: DataFrame, old_shard: Column, shards: int, text: str, doc_id: str) -> DataFrame:
    """``docs`` with doc_id, size, text_crc32, old_shard and the text's hash."""
    t, names = F.col(f"`{text}`"), ("shard", "slot", "__id", "__size", "__crc", "__old", "__hash")
    df = docs.withColumns({
        "__id": F.col(f"`{doc_id}`"), "__size": row_size(t), "__crc": F.crc32(F.coalesce(t, F.lit(""))),
        "__old": F.pmod(F.coalesce(old_shard, F.lit(0)), F.lit(shards)).cast("int"), "__hash": F.xxhash64(F.coalesce(t, F.lit(""))),
    })
    return df.select(*without(docs, *names).columns, *names[2:])


def _placed(rows: DataFrame, groups: DataFrame, buckets: int, fine: DataFrame | None = None) -> DataFrame:
    """``rows`` with the columns of their block's key."""
    df = rows.join(groups, "__hash", "left")
    df = df.withColumn("__part", F.when(F.col("__parts") > 1, F.pmod(F.xxhash64("__id", F.lit("part")), F.col("__parts"))).otherwise(-1).cast("int"))
    df = df.withColumn("__bucket", F.pmod("__hash", F.lit(buckets)).cast("int")).withColumn("__home", F.coalesce("__home", "__old")).drop("__parts")
    if fine is None:
        return df
    df = df.join(F.broadcast(fine), ["__home", "__bucket"], "left")  # shards * buckets rows at most
    sub = F.when((F.col("__part") < 0) & (F.col("__subs") > 1), F.pmod(F.xxhash64("__hash", F.lit("sub")), F.col("__subs"))).otherwise(0)
    return df.withColumn("__sub", sub.cast("int")).drop("__subs")


def plan_blocks(docs: DataFrame, old_shard: Column, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS) -> Plan:
    """The plan for ``docs``; ``old_shard`` numbers at most ``shards`` old shards from 0. Ids, sizes and hashes travel, texts don't."""
    spark: SparkSession = docs.sparkSession
    names = ["__id", "__size", "__old", "__hash"]
    rows = stored(_rows(docs, old_shard, shards, text, doc_id).select(*names), "reshard-rows")
    total = rows.agg(F.sum("__size").alias("bytes")).first().bytes or 0
    largest, whole = max(1, int(total / shards * LARGEST)), max(1, int(total / shards * WHOLE))
    held = rows.groupBy("__hash", "__old").agg(F.sum("__size").alias("bytes"))
    groups = held.groupBy("__hash").agg(F.max(F.struct("bytes", (-F.col("__old")).alias("o"))).alias("top"), F.sum("bytes").alias("bytes"), F.count("*").alias("k"))
    parts = F.when(F.col("bytes") > whole, F.ceil(F.col("bytes") / largest)).otherwise(1).cast("int")
    groups = stored(groups.where((F.col("k") > 1) | (F.col("bytes") > whole)).select("__hash", (-F.col("top.o")).alias("__home"), parts.alias("__parts")), "reshard-groups")
    rows = stored(_placed(rows, groups, buckets), "reshard-placed")
    subs = F.ceil(F.sum(F.when(F.col("__part") < 0, F.col("__size"))) / largest).cast("int")
    fine = stored(rows.groupBy("__home", "__bucket").agg(subs.alias("__subs")).where("__subs > 1"), "reshard-fine")
    rows = rows.join(F.broadcast(fine), ["__home", "__bucket"], "left").withColumn("__sub", F.when(F.col("__part") < 0, F.pmod(F.xxhash64("__hash", F.lit("sub")), F.coalesce("__subs", F.lit(1)))).otherwise(0).cast("int"))
    # at most shards * (buckets + a few / LARGEST) rows
    found = rows.groupBy(*_KEY).agg(F.sum("__size").alias("bytes"), F.count("*").alias("n"), F.collect_set("__old").alias("olds")).collect()
    key = lambda r: tuple(r[c] for c in _KEY)
    shard_of = deal_blocks([(key(r), r["__home"], r.bytes) for r in found], shards, largest)
    plan, filled, affected = [], [0] * shards, set()
    for r in sorted(found, key=key):
        j = shard_of[key(r)]
        plan.append((*key(r), j, filled[j]))
        filled[j] += r.n
        affected |= {x for o in r.olds if o != j for x in (o, j)}
    blocks = spark.createDataFrame(plan, "__home int, __bucket int, __sub int, __part int, shard int, __start long")
    return Plan(shards, buckets, groups, fine, blocks, sorted(affected), sorted({j for j in range(shards) if filled[j]} - affected))


def numbered(docs: DataFrame, old_shard: Column, plan: Plan, of: list[int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` of the new shards ``of``, with shard, slot and ``__old``; one shuffle by ranges of shard and block.

    A slot is what the blocks before hold plus the rank within the block, so no shard is numbered by one task."""
    rows = _placed(_rows(docs, old_shard, plan.shards, text, doc_id), plan.groups, plan.buckets, plan.fine)
    rows = rows.join(F.broadcast(plan.blocks), _KEY).where(F.col("shard").isin(of))
    rows = rows.repartitionByRange("shard", *_KEY)
    rank = F.row_number().over(Window.partitionBy("shard", *_KEY).orderBy("__id", "__crc", "__size"))
    return rows.withColumn("slot", F.col("__start") + rank - 1).drop("__start", "__hash", *_KEY)


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("__old").alias("old_shard"),
    )


def reshard(docs: DataFrame, old_shard: Column, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard): the plan, one row for each document; nothing is written."""
    plan = plan_blocks(docs, old_shard, shards, text, doc_id, buckets)
    return _result(numbered(docs.select(doc_id, text, old_shard.alias("__shard")), F.col("__shard"), plan, list(range(shards)), text, doc_id))


def rewrite(rows: DataFrame, folder: str) -> DataFrame:
    """Writes rows with shard and slot as ``shard=<n>`` folders and reads them back; all but a few tasks write into one shard."""
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    fields = [f for f in rows.schema.fields if f.name != "shard"]
    return rows.sparkSession.read.schema(T.StructType([*fields, rows.schema["shard"]])).parquet(folder)


def resharded(docs: DataFrame, old_shard: Column, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", folder: str | None = None) -> DataFrame:
    """:func:`reshard` carried out: affected shards, those that lose or gain rows, are written anew with all columns of
    ``docs`` below ``folder``, and their rows read back from the files. Rows of other shards stay where ``docs`` has them."""
    docs = docs.withColumn("__shard", old_shard)
    old = F.col("__shard")
    plan = plan_blocks(docs, old, shards, text, doc_id)
    t = F.col(f"`{text}`")
    out = docs.sparkSession.createDataFrame([], "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, old_shard int")
    if plan.affected:
        body = numbered(docs, old, plan, plan.affected, text, doc_id).drop("__id", "__size", "__crc", "__shard")
        back = rewrite(body, folder or new_path(docs.sparkSession, "resharded"))
        out = out.unionByName(_result(back.withColumns({"__id": F.col(f"`{doc_id}`").cast("long"), "__size": row_size(t), "__crc": F.crc32(F.coalesce(t, F.lit("")))})))
    if plan.left:
        out = out.unionByName(_result(numbered(docs.select(doc_id, text, "__shard"), old, plan, plan.left, text, doc_id)))
    return out
