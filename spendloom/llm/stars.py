"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import written


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node below a root has one edge, and no root is below another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component``: each node that a link (a, b) touches, and the least node that links reach from it."""
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    edges = written(ordered.distinct(), "edges")
    while not _is_forest_of_stars(edges):
        # Large star: neighbours above a node are linked to the least neighbour.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "stars")
        # Small star: a node and its neighbours below are linked to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        below = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(below.union(least).where("a != b").distinct(), "stars")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
