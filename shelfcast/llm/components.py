"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.workspace import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node of the component.

    A round is written out, so lost executors cost only running tasks. Rounds go with the logarithm of
    the largest component; they end when a round changes nothing. Nulls and loops are ignored.
    """
    stars = materialize(edges.select("a", "b").where("a <> b").distinct(), label)
    sign = None
    while True:
        row = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if tuple(row) == sign or row[0] == 0:
            break
        sign = tuple(row)
        stars = materialize(_small_star(_large_star(stars)), label)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
