"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import Shelf


def components(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """Of edges (a, b) between long ids: one row per node with its component's smallest node, as (node, root).

    Each round links every node's larger neighbours to its smallest one, then its smaller neighbours and itself, until the
    graph is a set of stars; the rounds needed grow with the logarithm of the graph. Smallest neighbours are combined
    before the shuffle, and the join back is a plain one, so a node with many edges is no hot group. Only one row of
    counts passes through the driver.
    """
    pairs = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = shelf.put(pairs, "edges")
    while not _stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = shelf.put(large.filter("a != b"), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.withColumnRenamed("m", "b")).filter("a != b").distinct()
        pairs = shelf.put(small, "small")
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stars(pairs: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or only edges to larger ones."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        pairs.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up + down > 1").isEmpty()
