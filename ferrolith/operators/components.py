"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.session import settle


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """(``node``, ``component``): the smallest node each node is connected to.

    ``edges`` has columns ``a`` and ``b``. Alternates the two star operations
    (large-star, small-star), which need a logarithmic number of rounds also
    for long chains, until nothing changes. Each round is settled in the shared folder, so lost
    executors do not restart the loop. A hub's edge list is the streamed side
    of a join with one row per node, which adaptive execution splits.
    """
    links = settle(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        links = settle(_small_star(_large_star(links)))
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == before:
            break
        before = (state["n"], state["h"])
    roots = links.select(F.col("a").alias(node), F.col("b").alias("component"))
    return nodes.select(node).join(roots, node, "left").select(
        node, F.coalesce("component", node).alias("component"))


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_low")).select("a", F.least("a", "_low").alias("_low"))
    larger = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("_low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("_low"))
    moved = links.join(least, "a").filter(F.col("b") != F.col("_low")).select(
        F.col("b").alias("a"), F.col("_low").alias("b"))
    return moved.unionByName(least.select("a", F.col("_low").alias("b"))).distinct()
