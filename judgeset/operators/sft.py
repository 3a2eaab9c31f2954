"""Rows for supervised fine-tuning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgeset.functions.text import quality_flags, stable_id


def sft_filter(df: DataFrame, include_rejected: bool = False) -> DataFrame:
    return df if include_rejected else df.filter("verdict = 'approve'")


def sft_rows(samples: DataFrame, judged: DataFrame, include_rejected: bool = False, track_costs: bool = True) -> DataFrame:
    """Samples joined with their ensemble rows; samples whose judgment failed drop out.

    What describes an ensemble is null where one judge answered. Judged rows are narrow, so they are what a large join
    moves twice; texts are moved once.
    """
    return sft_columns(samples.join(sft_filter(judged_columns(judged), include_rejected), "id"), track_costs)


def judged_columns(judged: DataFrame) -> DataFrame:
    """Ensemble rows by the id of their sample, under the names that they have beside it."""
    return judged.select(
        F.col("sample_id").alias("id"), "score", "verdict", "confidence", "score_std_dev", "num_judges", "individual_scores",
        F.col("reasoning").alias("judge_reasoning"), F.col("judge_models").alias("judge_model"), "judge_cost_usd",
    )


def sft_columns(df: DataFrame, track_costs: bool = True) -> DataFrame:
    """The rows of sft_rows from samples that are joined with judged_columns."""
    several = F.col("num_judges") > 1
    return df.select(
        stable_id("id").alias("id"), "input", "output", "answer", "model", "score", "problem_id", "tokens_in", "tokens_out", "judge_reasoning",
        "generation_time_ms", "judge_model", "verdict", quality_flags("output").alias("quality_flags"),
        F.when(several, F.col("confidence")).alias("judge_confidence"),
        F.when(several, F.col("score_std_dev")).alias("score_std_dev"),
        F.when(several, F.col("num_judges")).alias("num_judges"),
        F.when(several, F.col("individual_scores")).alias("individual_scores"),
        (F.coalesce("cost_usd", F.lit(0.0)) + F.coalesce("judge_cost_usd", F.lit(0.0)) if track_costs else F.lit(None).cast("double")).alias("cost_usd"),
        "metadata",
    )


def failed_requests(requests: DataFrame, ok: DataFrame, key: str = "request_id") -> DataFrame:
    """Requests without a usable result."""
    return requests.join(ok.select(key), key, "left_anti")
