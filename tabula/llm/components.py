"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node that occurs in
    ``links`` (a, b: bigint), by alternating large-star and small-star rounds.
    A round groups by node with partial minima and joins back, so a hub is no
    group in one task; every round is written to the checkpoint folder."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    def digest(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    state = digest(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = small.where("u <> v").distinct().checkpoint()
        now = digest(edges)
        if now == state:
            break
        state = now
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root")).distinct()
