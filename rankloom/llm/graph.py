"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle_table


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id that can be reached) of all ids in edges (a, b; whole numbers).

    Large and small stars in turn: every node hands its larger, then its
    smaller neighbours to the smallest of them, until nothing changes. Both
    steps are a partial aggregation and a join; each round is written to the
    shared folder, so no lineage grows.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, before = settle_table(pairs), None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = settle_table(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    found = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
