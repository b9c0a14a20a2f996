"""Connected components of links in a table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b): the smallest node reachable from each linked node.

    Every step is a map-side combined minimum and an equi-join back, so a node with many links
    is no group of its own; each round is written to the shared folder. The number of rounds
    grows with the logarithm of the longest path.
    """
    edges = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = written(large, "links")
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
