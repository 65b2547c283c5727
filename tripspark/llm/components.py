"""Connected components of an edge table by alternating star operations.

Large-star links every larger neighbour of a node to the smallest node in its
neighbourhood, small-star every smaller one and the node itself; both keep
components as they are, and repeated in turn they end in stars around each
component's smallest node, in few rounds for chains and stars alike. An
operation takes each node's least neighbour by an aggregate, which is combined
before its shuffle, and joins it back to the edges: one row a node on one side, so
Spark splits the edges of a hub that holds many of them. No node's neighbours are
gathered in a row or in memory, and no edge, node or component list reaches the
driver. The edges of each step are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node, with the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.least("m", "u").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours, each with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").filter("b <> m")
    return least.union(joined.select("b", "m")).toDF("a", "b")


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which has none itself, or none."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
    seen = ends.groupBy("u").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return seen.filter("ups > 1 OR ups = 1 AND least = 0").isEmpty()


def component_stars(edges: DataFrame) -> DataFrame:
    """(a, b) of every node a in ``edges`` (a, b: bigint) that can reach a smaller one, b being the
    smallest. A table; repeats are fine, loops count for nothing."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    edges = materialize(edges.distinct(), "cc-edges")
    while not _stars(edges):
        wide = materialize(_large_star(edges), "cc-wide")  # as many rows as edges
        edges = materialize(_small_star(wide).distinct(), "cc-edges")
    return edges


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: bigint); component is
    the smallest node that can be reached. Repeats are fine; loops count for nothing."""
    edges = component_stars(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct())
