"""Selection from finished datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def high_confidence(sft: DataFrame, min_score: float = 0.9) -> DataFrame:
    return sft.filter((F.col("score") >= min_score) & ~F.col("quality_flags.truncated") & F.col("quality_flags.has_reasoning"))


def confidence_tier(sft: DataFrame, hi: float = 0.9, mid: float = 0.7) -> DataFrame:
    """Adds tier: high_k, med_b or low_i; write_tiers splits a dataset by it."""
    tier = (
        F.when(F.col("quality_flags.truncated"), "low_i")
        .when((F.col("score") >= hi) & F.col("quality_flags.has_reasoning"), "high_k")
        .when(F.col("score") >= mid, "med_b")
        .otherwise("low_i")
    )
    return sft.withColumn("tier", tier)


TIERS = ("high_k", "med_b", "low_i")


def write_tiers(sft: DataFrame, path: str, hi: float = 0.9, mid: float = 0.7, mode: str = "errorifexists") -> None:
    """Writes a folder per tier in one pass over the rows, without a shuffle: each task writes a file for each of its tiers."""
    confidence_tier(sft, hi, mid).write.mode(mode).partitionBy("tier").parquet(path)


def read_tier(spark: SparkSession, path: str, *tiers: str) -> DataFrame:
    """Rows of these tiers (all without any), of which only the folders are read; a tier without rows gives none."""
    unknown = set(tiers) - set(TIERS)
    if unknown:
        raise ValueError(f"no such tier: {sorted(unknown)}")
    rows = spark.read.parquet(path)
    return rows.filter(F.col("tier").isin(*tiers)) if tiers else rows
