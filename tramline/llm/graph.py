"""Connected components by alternating stars, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import deleted, staged


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (a, b) leads to the root of its component: no a has two b, and no b is an a."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    met = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return met.filter((F.col("out") + F.col("in") > 1) & (F.col("out") > 0)).isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root for every node of ``edges`` (columns a, b); root is the smallest node of its component.

    Each pass hangs the larger neighbours of a node on its smallest neighbour, then the smaller ones;
    the number of passes grows with the logarithm of the longest path. Neighbours are never gathered:
    a minimum per node is combined map-side and joined back, and a node with many links is a skewed
    join, which adaptive execution splits. Nulls are not nodes. No edges give no rows.
    """
    pairs = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = staged(pairs, name)
    while not _are_stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # A row per edge at most; equal ones go with the pass's end.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # The node itself stays linked to its minimum through its own larger neighbours' turn.
        large = large.filter("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        small = small.filter("a <> b").distinct()
        last, current = current, staged(small, name)
        deleted(last)
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
