"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each row with the least of u and all its v; a hot u is split by the skew join."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = _with_least(down)
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        tied.select("u", F.col("m").alias("v")))


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its least node.

    Each round is written to the shared folder, so a lost executor costs one round. The rounds end when
    every node hangs on its least node, which count and hash sum of the edges show.
    """
    state, before = stored(edges.where("u <> v").select("u", "v").distinct(), name), None
    while True:
        for step in (large_star, small_star):
            state = step(state).where("u <> v").distinct()
        state = stored(state, name)
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
