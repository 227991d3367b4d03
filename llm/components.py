"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.columns import staged


def _digest(edges: DataFrame) -> tuple[int, ...]:
    """Tells tables of edges apart by their size and two 64-bit sums."""
    sums = [F.bit_xor(F.xxhash64("u", "v", F.lit(i))) for i in range(2)]
    return tuple(edges.agg(F.count("*"), *sums).first())


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for all nodes of the links (a, b).

    Alternating large-star and small-star steps: each hangs a node's neighbours on the smallest of them, first the larger
    ones, then the others with the node itself, until nothing changes. A step is one aggregation and one join, and a node
    with many links needs no list of them."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
        after = staged(small.distinct())
        now, then = _digest(after), _digest(edges)
        edges = after
        if now == then:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
