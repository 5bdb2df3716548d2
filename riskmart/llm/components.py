"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.session import checkpoint_table


def _is_star(edges: DataFrame) -> bool:
    """Whether every edge goes from a node without any other edge: then each component is a star around its ``b``."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out")).union(edges.select("b", F.lit(0)))
    bad = ends.groupBy("node").agg(F.sum("out").alias("out"), F.count(F.lit(1)).alias("all"))
    return bad.filter("out > 1 or (out = 1 and all > 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: of one orderable type); the component is its smallest node.

    Large-star and small-star steps in turn: every node hands its larger (then its smaller) neighbours over to the
    smallest one it knows, until the graph is a star around the smallest node of each component.  A step is an
    aggregate and a join, so a node with very many neighbours is never gathered in one place; each round is written to
    the shared checkpoint folder.
    """
    e = checkpoint_table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a <> b").distinct(), "cc")
    while not _is_star(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpoint_table(large.filter("a <> b"), "cc")  # repeated edges go with the next step
        # every edge goes from the larger node a to the smaller b
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(
            small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        e = checkpoint_table(small.distinct(), "cc")
    own = e.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own).distinct()
