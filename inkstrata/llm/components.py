"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.llm.store import drop, written


def _round(now: DataFrame) -> DataFrame:
    """A large-star and a small-star of edges (u, v), u > v."""
    pairs = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = pairs.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))  # u > v
    large = large.filter("u <> v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
    return small.filter("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable, for each node of edges (a, b) that has one.

    Rounds of large-star and small-star: each hangs a node's neighbours under the least of them, and the
    number of rounds grows with the logarithm of the longest path. Every round is written to the shared
    folder. Loops and repeated edges are allowed; an empty table gives an empty result."""
    both = edges.select("a", "b").filter("a <> b").distinct()
    now = written(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    stamp = None
    for _ in range(most_rounds):
        after = written(_round(now), "edges")
        drop(now)
        now = after
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == stamp:
            break
        stamp = tuple(seen)
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    found = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return found.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
