"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.sources.scratch import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other, which hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.filter("hangs + holds > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b) but the roots themselves; the root is the least node.

    A star's centre may have any number of links: minima are joined on the executors before the shuffle, and the join
    back to the links is one that adaptive execution can split.  Every round is written to the shared folder.
    """
    stars = store(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(stars):
        stars = store(_small_star(_large_star(stars)))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
