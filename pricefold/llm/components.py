"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import stored

#: Far beyond what logarithmic convergence needs.
ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def _each(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Several pairs (u, v) of each row in one pass; a union would plan the rows' source once for each of them."""
    return edges.select(F.explode(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs])).alias("pair")).select("pair.*").where("u <> v")


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of each node and its neighbours; partial minima keep hot nodes cheap."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b; any order, repeats allowed); component is the smallest node.

    Each round's edges are a written table, so lineage doesn't grow and a lost executor costs one round. A node's edges
    may be many: joins on nodes are plain equi-joins, which adaptive execution splits. Plans are small, as the driver holds
    and compiles those of every round."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _state(edges)
    if not before[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(ROUNDS):
        both = _each(edges, ("u", "v"), ("v", "u"))
        large = both.join(_smallest(both), "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        pointed = large.join(_smallest(large), "u")
        edges = stored(_each(pointed, ("v", "m"), ("u", "m")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    centres = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres.select("node", F.col("node").alias("component")))
