"""Preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.config import check_responses
from judgeset.functions.text import stable_id

MIN_GAP = 0.1


def expand_responses(problems: DataFrame, n: int) -> DataFrame:
    """n rows per problem, numbered by response_idx; id is the problem's id with that number."""
    check_responses(n)
    rows = problems.withColumn("response_idx", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumnRenamed("id", "problem_id").withColumn("id", F.concat_ws("_", "problem_id", F.col("response_idx").cast("string")))


def best_and_worst(judged: DataFrame) -> DataFrame:
    """Per problem with two responses or more: sample ids, scores, models and outputs of the best and the worst.

    Ties go to the earliest response for the best and the latest for the worst. The aggregate combines before the
    shuffle, so a problem with any number of responses is one row with two texts per task.
    """
    rank = F.struct("score", (-F.col("response_idx")).alias("i"))
    row = F.struct("sample_id", "score", "model", "response_idx", "output")
    best = judged.groupBy("problem_id").agg(F.max_by(row, rank).alias("c"), F.min_by(row, rank).alias("r"), F.count(F.lit(1)).alias("n"))
    return best.filter("n >= 2").select("problem_id", F.col("c.sample_id").alias("chosen_id"), F.col("r.sample_id").alias("rejected_id"), F.col("c.score").alias("chosen_score"), F.col("r.score").alias("rejected_score"), F.col("c.model").alias("chosen_model"), F.col("r.model").alias("rejected_model"), F.col("c.response_idx").alias("chosen_idx"), F.col("r.response_idx").alias("rejected_idx"), F.col("c.output").alias("chosen"), F.col("r.output").alias("rejected"))


def dpo_pairs(judged: DataFrame, problems: DataFrame, min_gap: float = MIN_GAP) -> DataFrame:
    """One pair per problem whose best and worst score are min_gap apart (in plain double arithmetic).

    judged has sample_id, problem_id, response_idx, score, model and output. The two texts of a problem come with its best
    and worst score, so no text is looked for afterwards.
    """
    pairs = best_and_worst(judged).filter(F.col("chosen_score") - F.col("rejected_score") >= min_gap)
    p = problems.select(F.col("id").alias("problem_id"), "input", "metadata")
    return pairs.join(p, "problem_id").select(
        stable_id("problem_id").alias("id"), "problem_id", "input", "chosen", "rejected", "chosen_score", "rejected_score", "chosen_model", "rejected_model", "metadata",
    )


def insufficient(tasks: DataFrame, generated: DataFrame, judged: DataFrame) -> DataFrame:
    """Problems that cannot give a pair: (problem_id, reason). Each input has problem_id; tasks has every problem."""
    g = generated.groupBy("problem_id").agg(F.count(F.lit(1)).alias("g"))
    j = judged.groupBy("problem_id").agg(F.count(F.lit(1)).alias("j"))
    n = tasks.select("problem_id").distinct().join(g, "problem_id", "left").join(j, "problem_id", "left")
    reason = F.when(F.coalesce("g", F.lit(0)) < 2, "insufficient_samples").when(F.coalesce("j", F.lit(0)) < 2, "judgment_failed")
    return n.select("problem_id", reason.alias("reason")).filter("reason IS NOT NULL")


def preference_rank(judged: DataFrame) -> DataFrame:
    """Adds rank: 1 for the best response of a problem, ties in order of response_idx."""
    return judged.withColumn("rank", F.row_number().over(W.partitionBy("problem_id").orderBy(F.desc("score"), "response_idx")))
