"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.sources.scratch import saved

ROUNDS = 40


def _large_star(e: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest it knows, itself included."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    low = e.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
    least = low.groupBy("b").agg(F.min("a").alias("m"))
    links = low.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return links.unionByName(least.select(F.col("m").alias("a"), "b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes of edges (a, b), of one ordered type.

    Each round is written; the number of rounds grows with the logarithm of the longest path.
    """
    e = saved(edges.select("a", "b").where("a <> b").distinct(), "edges")
    told = None
    for _ in range(ROUNDS):
        e = saved(_small_star(_large_star(e)), "stars")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == told:
            return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        told = now
    raise RuntimeError(f"components are not settled after {ROUNDS} rounds")
