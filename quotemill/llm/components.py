"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.shared import land


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours.

    Links may repeat, never more than there were; the small star after it takes each once.
    """
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these neighbours."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one link at most to a smaller one, which has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down + up > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    ``edges`` has columns u and v of one ordered type, without nulls; loops and repeated
    edges are allowed. A node is joined with its own neighbours only: minima are taken before
    the shuffle, and the join of a hub with its links is one that Spark splits. Each round
    is written to the shared folder. An edge table without rows gives none.
    """
    now = land(small_star(edges.where("u <> v").select("u", "v")), "star")
    while not _is_stars(now):
        now = land(small_star(large_star(now)), "star")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(roots).distinct()
