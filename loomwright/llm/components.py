"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import durable


def _state(edges: DataFrame) -> tuple:
    """Count and checksum, to see that a step changed nothing."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    Each step is an aggregate of minima, combined before its shuffle, and a join that AQE may split, so a node with
    very many neighbours never meets them in one task. The number of steps grows with the logarithm of the longest path.
    """
    links = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = durable(links)
    before = _state(links)
    while True:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = durable(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        links = durable(small)
        after = _state(links)
        if after == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
