"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.session import settle


def smallest_linked(pairs) -> dict:
    """Smallest item connected to each item of the pairs."""
    root: dict = {}

    def find(i):
        while root.setdefault(i, i) != i:
            root[i] = i = root[root[i]]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in list(root)}


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component = smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each step takes the smallest
    neighbor per node, a partial aggregate, and rewires the edges to it. The result of every
    round is written to shared storage.
    """
    ordered = F.struct(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    current = settle(edges.where("a <> b").select(ordered.alias("e")).select("e.*").distinct())
    before = None
    for _ in range(max_rounds):
        current = settle(_small_star(_large_star(current)))
        state = current.agg(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64("low", "high")),
            F.bit_xor(F.xxhash64("high", "low", F.lit(1))),
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    found = current.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each larger neighbor of a node to the smallest node around it."""
    both = edges.select(F.col("low").alias("n"), F.col("high").alias("m")).unionByName(
        edges.select(F.col("high").alias("n"), F.col("low").alias("m"))
    )
    smallest = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least_m"))
    return (
        both.where("m > n").join(smallest, "n")
        .select(F.col("least_m").alias("low"), F.col("m").alias("high"))
        .where("low <> high").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbors to the smallest of them."""
    smallest = edges.groupBy("high").agg(F.min("low").alias("least_m"))
    rewired = edges.join(smallest, "high").select(
        F.col("least_m").alias("low"), F.col("low").alias("high")
    )
    kept = smallest.select(F.col("least_m").alias("low"), "high")
    return rewired.unionByName(kept).where("low <> high").distinct()
