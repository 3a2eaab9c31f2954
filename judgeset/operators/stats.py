"""Run statistics, costs and usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stats(df: DataFrame, runtime_secs: float) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.col("total_approved"), F.col("total_judged")), F.lit(0.0))
    speed = F.col("total_approved") / F.lit(runtime_secs) * F.lit(3600.0) if runtime_secs > 0 else F.lit(0.0)
    return df.select("total_problems", "total_generated", "total_judged", "total_approved", "total_rejected", "generation_cost_usd", "judge_cost_usd", F.lit(float(runtime_secs)).alias("runtime_secs"), speed.cast("double").alias("throughput_per_hour"), rate.cast("double").alias("approval_rate"))


def _sum(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("kind"))


def run_stats_sft(problems: DataFrame, samples: DataFrame, judged: DataFrame, runtime_secs: float) -> DataFrame:
    """One row. judged has verdict, cost_usd (generation) and judge_cost_usd; costs count judged samples only."""
    j = judged.agg(F.count(F.lit(1)).alias("total_judged"), F.count_if(F.col("verdict") == "approve").alias("total_approved"), F.count_if(F.col("verdict") != "approve").alias("total_rejected"), _sum("cost_usd").cast("double").alias("generation_cost_usd"), _sum("judge_cost_usd").cast("double").alias("judge_cost_usd"))
    n = _rows(problems, "p").unionByName(_rows(samples, "s")).agg(F.count_if(F.col("kind") == "p").alias("total_problems"), F.count_if(F.col("kind") == "s").alias("total_generated"))
    return _stats(j.withColumn("one", F.lit(1)).join(n.withColumn("one", F.lit(1)), "one"), runtime_secs)


def run_stats_dpo(problems: DataFrame, samples: DataFrame, judged: DataFrame, pairs: DataFrame, runtime_secs: float) -> DataFrame:
    """One row; approved counts pairs, rejected counts problems with a judged response and no pair."""
    j = judged.agg(F.count(F.lit(1)).alias("total_judged"), F.countDistinct("problem_id").alias("groups"), _sum("cost_usd").cast("double").alias("generation_cost_usd"), _sum("judge_cost_usd").cast("double").alias("judge_cost_usd"))
    n = _rows(problems, "p").unionByName(_rows(samples, "s")).unionByName(_rows(pairs, "d")).agg(F.count_if(F.col("kind") == "p").alias("total_problems"), F.count_if(F.col("kind") == "s").alias("total_generated"), F.count_if(F.col("kind") == "d").alias("total_approved"))
    both = j.withColumn("one", F.lit(1)).join(n.withColumn("one", F.lit(1)), "one").withColumn("total_rejected", F.col("groups") - F.col("total_approved"))
    return _stats(both, runtime_secs)


def cost_by_model(sft: DataFrame) -> DataFrame:
    return sft.groupBy("model").agg(F.count(F.lit(1)).alias("samples"), F.sum(F.coalesce("cost_usd", F.lit(0.0))).alias("cost_usd"))


def usage_by_endpoint(samples: DataFrame) -> DataFrame:
    """Tokens and cost per endpoint; micro-dollars are cut off per request before they are added up."""
    return samples.groupBy("endpoint").agg(F.count(F.lit(1)).alias("requests"), _sum("tokens_in").alias("tokens_in"), _sum("tokens_out").alias("tokens_out"), F.sum("cost_usd").alias("cost_usd"), F.sum(F.floor(F.col("cost_usd") * 1e6).cast("bigint")).alias("cost_micros"))


def usage_rollup(samples: DataFrame) -> DataFrame:
    """Requests, tokens and cost by endpoint and model, by endpoint, and over all, in one pass.

    level tells the rows apart: 0 for a model of an endpoint, 1 for an endpoint, 3 for all; so the totals of rows whose
    own model or endpoint is null are not taken for sums over it.
    """
    level = F.grouping_id().cast("int").alias("level")
    return samples.rollup("endpoint", "model").agg(level, F.count(F.lit(1)).alias("requests"), _sum("tokens_in").alias("tokens_in"), _sum("tokens_out").alias("tokens_out"), F.sum("cost_usd").alias("cost_usd"))
