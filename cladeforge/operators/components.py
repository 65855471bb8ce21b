"""Connected components by alternating large and small stars (Kiveris et al. 2014), one pair of joins a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.sources.scratch import kept as checkpointed


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of every node in edges (a, b) except the roots.

    Each round turns every node's links to its least neighbour. A node with very many neighbours is never gathered: its
    least neighbour is an aggregate, and the join that carries it back can be split where it is skewed.
    """
    edges = checkpointed(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = _print(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(down, "b")
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a <> b").union(joined.select(F.col("m").alias("a"), "b")).distinct()
        edges = checkpointed(small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        after = _print(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
