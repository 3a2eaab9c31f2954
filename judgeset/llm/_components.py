"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (its smallest reachable node) of every node that an edge between two nodes touches.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest; the number of edges never
    grows and a handful of rounds ends it. Rounds are joins and aggregates over edges, written to the shared folder.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    now = scratch.keep(e, "edges")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.keep(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u > v").distinct()
        following = scratch.keep(small, "small")
        scratch.drop(large, now)
        now = following
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node but the centres has one edge, to a centre."""
    centre = edges.select(F.col("v").alias("u")).distinct().withColumn("x", F.lit(10).cast("long"))
    return edges.select("u", F.lit(1).cast("long").alias("x")).unionByName(centre).groupBy("u").agg(F.sum("x").alias("x")).filter("x NOT IN (1, 10)").isEmpty()
