"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on node ids; edges are written to
the shared folder between rounds, so a lost executor costs one round at most.
A node's edges are never gathered in one row: its smallest neighbour comes
from a partial aggregate, and the join back is an inner join whose skewed
partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v) edges, u > v."""
    if large:  # from every node to its larger neighbours, smaller ones included in the minimum
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # from every node to its smaller neighbours and itself
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        down = edges.join(least, "u").select("u", "v", "m")
        moved = down.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return moved.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of undirected ``links`` (a, b): root is the least node id reachable.

    Self links and repeated links do no harm; an empty table of links gives an
    empty result. Raises if ``max_rounds`` do not suffice (they grow with the
    logarithm of the number of nodes).
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = land(edges, "cc")
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        edges = land(_star(_star(edges, large=True), large=False), "cc")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
