"""Connected components of a graph of links, by alternating stars, with a written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywork.llm.common import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Every round points the larger neighbours of each node at its smallest neighbour (large star), then the smaller ones
    (small star); rounds grow with the logarithm of the nodes. Minima are taken in the map tasks first and joins are
    plain inner joins that adaptive execution can split, so a node with very many links is no bottleneck. Links with a
    null end are left out; a link of a node to itself and repeated links change nothing. No links give no rows.
    """
    x, y = F.col(a), F.col(b)
    ends = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where(
        x.isNotNull() & y.isNotNull()
    )
    stars = materialise(ends.distinct(), "links")
    before = None
    while True:
        # Large star: with m the smallest of a node and its neighbours, larger neighbours point at m.
        edges = stars.where("u != v")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both, F.least(F.min("v"), F.first("u")))
        large = both.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u != v").distinct(), "links")
        # Small star: with m the smallest of the smaller neighbours, they and the node point at m.
        low = _lowest(large, F.min("v"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = small.union(low.select("u", F.col("m").alias("v")))
        selves = stars.where("u = v")
        stars = materialise(found.union(selves).distinct(), "links")
        # The stars are final when a round leaves them as they are.
        state = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return nodes.union(roots).groupBy("node").agg(F.min("component").alias("component"))


def _lowest(edges: DataFrame, lowest) -> DataFrame:
    """(u, m) per node; written, so that a join with it is between plain shuffles and its hot nodes can be split."""
    return materialise(edges.groupBy("u").agg(lowest.alias("m")), "lowest")
