"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import landed


def connected(edges: DataFrame) -> DataFrame:
    """``edges`` has long columns a and b; returns (node, component), component the least node.

    Each round joins every neighbour to the least node in reach and is written to
    the shared folder; the rounds grow with the logarithm of the longest path.
    Nodes without an edge to another node are not listed.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = landed(edges.distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.where(F.col("b") > F.col("a"))
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = edges.unionByName(small.select("a", F.col("m").alias("b")))
        edges = landed(edges.where("a > b").distinct(), "stars")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = new
