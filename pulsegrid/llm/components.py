"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregates and joins over the edge table; the table is
written to the shared folder after each round, so nothing is gathered on the
driver but one checksum row. Isolated nodes are not in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (a > b); returns distinct edges (a > b)."""
    both = edges if not large else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:  # neighbours above the node move to its least neighbour
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # neighbours below the node, and the node, move to the least one
        moved = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _checksum(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; any direction,
    repeats and loops allowed); root is the smallest node of the component."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stage(now, "edges")
    seen = _checksum(now)
    while seen[0]:
        now = stage(_star(stage(_star(now, True), "large"), False), "small")
        new = _checksum(now)
        if new == seen:
            break
        seen = new
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
