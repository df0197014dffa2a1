"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm._io import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str, steps: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), for every node on an edge.

    Each step hangs neighbours under the smallest one they know; a node with
    very many neighbours is an aggregate and a join, never one task's group.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.keep(edges.distinct(), f"{name}-0")
    mark = None
    for step in range(1, steps):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # After a large-star step every edge points from the larger to the smaller node.
        large = large.distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = small.unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        edges = scratch.keep(new, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return labels.unionByName(roots)
        mark = seen
    raise RuntimeError(f"no fixed point after {steps} steps")
