"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commutewell.llm.common import stored


def _with_least(edges: DataFrame, name: str) -> DataFrame:
    """``edges`` (u, v) with the least neighbour of u, or u itself, as m.

    The minima combine before their shuffle. They are stored, so that the join shuffles both sides itself and
    a node with very many edges can be split at run time.
    """
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
    return edges.join(least.select("u", F.least("u", "m").alias("m")), "u")


def _stars(edges: DataFrame) -> bool:
    """Does every edge (u, v) lead straight to the smallest node: no u twice, no v that is also a u?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("root"))
    )
    nodes = ends.groupBy("node").agg(F.sum("child").alias("n"), F.max("root").alias("root"))
    return nodes.filter("n > 1 OR (n = 1 AND root = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (u, v); the component is its smallest node.

    Loops and repeated links do no harm; no links give no rows. Each round is written to the shared folder.
    The rounds end when all edges lead straight to the smallest node.
    """
    edges = stored(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u is tied to u's least neighbour.
        large = _with_least(both, "large").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large")
        # Small star: u and its smaller neighbours are tied to the least of them.
        small = _with_least(large, "small").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.*").filter("u <> v").distinct(), "small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
