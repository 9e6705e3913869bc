"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the smallest node reachable.

    Each round links the neighbours of a node to their smallest one, first the larger,
    then the smaller neighbours. Minima are aggregates, so a node with very many
    neighbours is combined before the shuffle and never gathered. A round is written to the shared
    folder, which cuts the lineage; the loop ends when a round changes nothing.
    """
    current = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = current.select("a", "b").union(current.select(F.col("b"), F.col("a")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = seen
