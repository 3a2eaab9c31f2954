"""One score, verdict and confidence per sample from its judges' results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgeset.config import EnsembleConfig, ModelSpec
from judgeset.operators.models import weights


def _sum(values: Column) -> Column:
    """Adds in the array's order, so that the result does not depend on partitions."""
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def mean(scores: Column) -> Column:
    return F.when(F.size(scores) > 0, _sum(scores) / F.size(scores))


def median(scores: Column) -> Column:
    s, n = F.array_sort(scores), F.size(scores)
    upper, lower = F.get(s, F.floor(n / 2).cast("int")), F.get(s, F.floor(n / 2).cast("int") - 1)
    return F.when(n % 2 == 0, (lower + upper) / 2).otherwise(upper)


def weighted_mean(scores: Column, w: Column) -> Column:
    total = F.aggregate(w, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, _sum(F.zip_with(scores, w, lambda s, x: s * x)) / total).otherwise(mean(scores))


def std_dev(scores: Column) -> Column:
    """Of the population, around the mean, in two passes."""
    m = mean(scores)
    return F.sqrt(_sum(F.transform(scores, lambda s: (s - m) * (s - m))) / F.size(scores))


def majority_verdict(approvals: Column, n: Column) -> Column:
    return F.when(approvals > F.floor(n / 2), "approve").otherwise("reject")


def confidence(std: Column, approvals: Column, n: Column, verdict: Column, threshold: float) -> Column:
    agree = F.when(verdict == "approve", approvals == n).otherwise(approvals == 0)
    return F.when(std >= threshold, "low").when(agree, "high").otherwise("medium")


def aggregate_scores(judge_results: DataFrame, models: list[ModelSpec] | None = None, strategy: str = "median") -> DataFrame:
    """sample_id, score, score_std_dev, the first judge's reasoning and the sorted judge rows (js). A group is as large as the number of judges."""
    df = judge_results
    if strategy == "weightedaverage":
        df = df.join(F.broadcast(weights(df, models or [])), "judge_model", "left").withColumn("weight", F.coalesce("weight", F.lit(1)).cast("double"))
    else:
        df = df.withColumn("weight", F.lit(1.0))
    row = F.struct("judge_ordinal", "score", "weight", "verdict", "judge_model", "judge_cost_usd", "judge_time_ms")
    # only the first judge's text is kept, so only one text per sample and task is shuffled
    grouped = df.groupBy("sample_id").agg(F.sort_array(F.collect_list(row)).alias("js"), F.min_by("reasoning", "judge_ordinal").alias("reasoning"))
    scores, w = F.transform("js", lambda j: j["score"]), F.transform("js", lambda j: j["weight"])
    grouped = grouped.withColumn("individual_scores", scores).withColumn("__w", w)
    score = {"median": lambda: median(F.col("individual_scores")), "average": lambda: mean(F.col("individual_scores")), "weightedaverage": lambda: weighted_mean(F.col("individual_scores"), F.col("__w"))}[strategy]()
    return grouped.withColumn("score", score).withColumn("score_std_dev", std_dev(F.col("individual_scores"))).drop("__w")


def ensemble(judge_results: DataFrame, cfg: EnsembleConfig, models: list[ModelSpec] | None = None) -> DataFrame:
    """One row per sample that at least one judge answered."""
    df = aggregate_scores(judge_results, models, cfg.strategy)
    n = F.size("js")
    approvals = F.size(F.filter("js", lambda j: j["verdict"] == "approve"))
    df = df.withColumn("verdict", majority_verdict(approvals, n))
    return df.select(
        "sample_id", "score", "verdict",
        confidence(F.col("score_std_dev"), approvals, n, F.col("verdict"), cfg.disagreement_threshold).alias("confidence"),
        "score_std_dev", n.alias("num_judges"), "individual_scores",
        "reasoning",
        F.array_join(F.transform("js", lambda j: j["judge_model"]), ",").alias("judge_models"),
        F.array_max(F.transform("js", lambda j: j["judge_time_ms"])).alias("judge_time_ms"),
        F.aggregate("js", F.lit(0.0), lambda a, j: a + F.coalesce(j["judge_cost_usd"], F.lit(0.0))).alias("judge_cost_usd"),
    )


def wrap_single(judge_results: DataFrame) -> DataFrame:
    """Ensemble rows of samples that one judge scored: its score and verdict, high confidence, no spread."""
    return judge_results.select(
        "sample_id", "score", "verdict", F.lit("high").alias("confidence"), F.lit(0.0).alias("score_std_dev"), F.lit(1).alias("num_judges"),
        F.array("score").alias("individual_scores"), "reasoning", F.col("judge_model").alias("judge_models"), "judge_time_ms", F.coalesce("judge_cost_usd", F.lit(0.0)).alias("judge_cost_usd"),
    )


def needs_escalation(score: Column, low: float, high: float) -> Column:
    return (score >= low) & (score <= high)


def hierarchical(cheap: DataFrame, full: DataFrame, cfg: EnsembleConfig, models: list[ModelSpec] | None = None, include_cheap_cost: bool = False) -> DataFrame:
    """cheap has one judge result per sample, full the ensemble's results of at least the uncertain samples.

    Scores inside the uncertain range go to the ensemble, whose row then stands alone; with include_cheap_cost the
    first judge's cost is added to it.
    """
    low, high = cfg.uncertain_range
    unsure = needs_escalation(F.col("score"), low, high)
    sure = wrap_single(cheap.filter(~unsure))
    asked = cheap.filter(unsure).select("sample_id", F.col("judge_cost_usd").alias("__cheap"))
    rows = ensemble(full.join(asked.select("sample_id"), "sample_id", "left_semi"), cfg, models)
    if include_cheap_cost:
        rows = rows.join(asked, "sample_id").withColumn("judge_cost_usd", F.col("judge_cost_usd") + F.coalesce("__cheap", F.lit(0.0))).drop("__cheap")
    return sure.unionByName(rows)


def evaluate(judge_results: DataFrame, cfg: EnsembleConfig, models: list[ModelSpec] | None = None, cheap: DataFrame | None = None) -> DataFrame:
    """Single, hierarchical or ensemble by the settings. A single judge is the one with ordinal 0."""
    if not cfg.enabled:
        return wrap_single(judge_results.filter("judge_ordinal = 0"))
    if cfg.hierarchical:
        return hierarchical(cheap if cheap is not None else judge_results.filter("judge_ordinal = 0"), judge_results, cfg, models)
    return ensemble(judge_results, cfg, models)
