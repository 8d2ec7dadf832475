"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component: smallest node.

    Both star steps first take minima with map-side combine, store them, and join them back to
    the edges, so adaptive execution may split the edges of a hub over tasks. Rounds needed grow
    with the logarithm of the longest path, not with its length. Loops, repeated edges and edges
    with a null end are allowed and change nothing (nodes with no other edge are not returned).
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stored(
        edges.where("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "links"
    )
    mark = _mark(now)
    for _ in range(rounds):
        if not mark[0]:
            break
        # large star: every larger neighbour of a node moves to the node's smallest neighbour
        near = stored(
            now.select("u", F.col("v").alias("m"))
            .union(now.select("v", F.col("v")))  # a node that has larger neighbours knows itself
            .groupBy(F.col("u").alias("node")).agg(F.min("m").alias("m")), "near",
        )
        large = now.join(near, now.v == near.node).select("u", F.col("m").alias("v"))
        large = stored(large.distinct(), "large")
        # small star: a node and its smaller neighbours move to the smallest of them
        least = stored(
            large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")), "least"
        )
        moved = large.join(least, large.u == least.node).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).where("u <> v")
        now = stored(
            moved.union(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct(),
            "links",
        )
        before, mark = mark, _mark(now)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
