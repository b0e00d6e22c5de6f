"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import cut_lineage


def _nearest(edges: DataFrame) -> DataFrame:
    """(a, b, m): each edge with the least node among a and its neighbours.

    Minima are pre-aggregated and joined back, so a node with many edges is split."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least.withColumn("m", F.least("a", "m")), "a")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of the different ``edges`` has one neighbour b, or is a b, and not both."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("n"))
    ends = ends.unionAll(edges.select(F.col("b").alias("node"), F.lit(0).alias("n")))
    ends = ends.groupBy("node").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    return ends.filter("n > 1 or n > least").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) is connected with.

    Alternates large-star and small-star steps until the edges are stars around least nodes.
    Loops and repeated edges are allowed; nodes without edges don't come out.
    """
    found = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    found = cut_lineage(found)
    while True:
        both = found.unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _nearest(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = _nearest(large)
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            small.select("a", F.col("m").alias("b"))
        )
        found = cut_lineage(small.filter("a <> b").distinct())
        if _are_stars(found):
            break
    stars = found.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = found.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(roots.distinct())
