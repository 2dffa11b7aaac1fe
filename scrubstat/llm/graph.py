"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b): root is the smallest node of its component, nodes that are
    roots included. Alternating large-star and small-star steps; the minimum of a node's neighbours
    is a partial aggregate, written before it is joined back, so that a hub is split like any skewed key.
    Each round's edges are written to the shared scratch folder."""
    e = write_through(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    while not e.isEmpty():
        both = e.union(e.select("b", "a"))
        least = write_through(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "edges")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = write_through(large, "edges")
        lowest = write_through(large.groupBy("a").agg(F.min("b").alias("m")), "edges")
        small = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = write_through(small.union(lowest).distinct(), "edges")
        # Done when every node but the roots has one parent, and that is a root.
        n, children = e.agg(F.count("*"), F.count_distinct("a")).first()
        if n == children and e.join(e.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
    return nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))
