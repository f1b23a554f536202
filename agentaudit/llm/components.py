"""Connected components of a graph given as edges, by alternating stars.

A round hangs every edge's larger end under the smallest neighbour of its smaller end
(large star), then joins each node's smaller neighbours under the smallest of them
(small star). The edges become a forest of stars in about log2 rounds. A round is four
joins or aggregations over stored tables; nothing but two counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    ``edges`` has long columns ``a`` and ``b``; loops, repeats and either order are fine.
    """
    tree = stored(edges.where("a != b").select(
        F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), "edges")
    while True:
        parents = stored(tree.groupBy("x").agg(F.min("y").alias("parent")), "parents")
        above = parents.select(F.col("x").alias("y"), F.col("parent").alias("top"))
        large = stored(tree.join(above, "y", "left").select(
            "x", F.coalesce("top", "y").alias("y"), F.col("top").isNotNull().alias("moved")), "large")
        rows, moved = large.agg(F.count(F.lit(1)), F.coalesce(F.max("moved"), F.lit(False))).first()
        if not moved and rows == parents.count():
            return tree.select(F.col("x").alias("node"), F.col("y").alias("root"))
        lowest = stored(large.groupBy("x").agg(F.min("y").alias("parent")), "lowest")
        small = large.join(lowest, "x")
        tree = stored(
            small.where("y != parent").select(F.col("y").alias("x"), F.col("parent").alias("y"))
            .unionByName(lowest.select("x", F.col("parent").alias("y"))).distinct(), "tree")
