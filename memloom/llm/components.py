"""Connected components of an edge table, by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memloom.llm.common import discard, join_unique, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large: each node's larger neighbours point to the least node around it.  Small: its smaller neighbours and itself do."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    # A root may hold most edges.
    least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("count")), "least")
    joined = join_unique(both, least.select("u", "m"), "u", least.select("u", "count"))
    out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")) if large else joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): for every node on an edge the least node that it reaches.  edges: a, b of one ordered type.

    Rounds grow with the logarithm of the longest chain; if so many don't
    settle it, that is an error.
    """
    now, seen = written(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges"), None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen, last = state, now
        now = written(_stars(written(_stars(now, True), "edges"), False), "edges")
        discard(last)
    raise RuntimeError("components have not settled")
