"""Connected components by alternating large and small stars, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the smallest node reachable.

    Minima are combined before the shuffle, so a node may have any number of edges.
    The number of rounds grows with the logarithm of the nodes. A node whose edges
    all lead to itself is its own root.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    loops = edges.where("a = b")
    stars = stored(_directed(edges), "stars")
    state = _state(stars)
    while True:
        stars = stored(_small_star(_large_star(stars)), "stars")
        before, state = state, _state(stars)
        if state == before:
            break
    linked = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    alone = loops.select(F.col("a").alias("node")).distinct().join(
        linked.select("node").union(roots.select("node")), "node", "left_anti"
    )
    return linked.union(roots).union(alone.select("node", F.col("node").alias("root")))


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _state(stars: DataFrame) -> tuple:
    return tuple(
        stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to its smallest neighbour or itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("m"))
    return _directed(
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a")
    return _directed(
        linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            linked.select("a", F.col("m").alias("b"))
        )
    )
