"""Rows in the shape that common trainers read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.operators.prefix import running
from judgeset.sources.files import shared_path


def to_sft(sft: DataFrame) -> DataFrame:
    return sft.select(F.col("input").alias("prompt"), F.col("output").alias("completion"))


def to_dpo(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("input").alias("prompt"), "chosen", "rejected")


def to_reward(sft: DataFrame) -> DataFrame:
    return sft.select(F.col("input").alias("prompt"), F.col("output").alias("completion"), F.col("score").alias("reward"))


def to_kto(sft: DataFrame, threshold: float = 0.85) -> DataFrame:
    return sft.select(F.col("input").alias("prompt"), F.col("output").alias("completion"), (F.col("score") >= threshold).alias("label"))


#: What a trainer's rows are made of, by the name of the format.
FORMATS = {"sft": ("prompt", "completion"), "dpo": ("prompt", "chosen", "rejected"), "reward": ("prompt", "completion", "reward"), "kto": ("prompt", "completion", "label"), "grpo": ("problem_id", "part", "prompt", "completions", "scores")}


def write_trainer(rows: DataFrame, path: str, kind: str, fields: dict[str, str] | None = None, mode: str = "errorifexists") -> None:
    """Writes trainer rows (of to_sft, to_dpo, to_reward, to_kto or to_grpo) as JSON lines in the format's order of
    fields. fields maps the format's names to those that a trainer's configuration asks for, such as prompt to input. A
    row that lacks one of its fields (null) fails the write, since a trainer would read it as a shorter row."""
    names = FORMATS[kind]
    fields = fields or {}
    if unknown := set(fields) - set(names):
        raise ValueError(f"{kind} has no such field: {sorted(unknown)}")
    needed = lambda c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a row has no {c}"))).otherwise(F.col(c)).alias(fields.get(c, c))
    rows.select(F.to_json(F.struct(*[needed(c) for c in names])).alias("value")).write.mode(mode).text(path)


#: Problems with more responses than this, and more than a row holds, are dealt to many tasks; smaller ones are one task's.
DEALT = 1024


def to_grpo(judged: DataFrame, most: int = 1024, path: str | None = None) -> DataFrame:
    """(problem_id, part, prompt, completions, scores): every problem with all its judged responses, completions and
    scores aligned by response_idx. A problem with more than most responses stands in several rows, parts 0, 1, ... of
    most responses each; the prompt is the first response's of each part. A null problem_id is a problem of its own.

    Responses are counted first, without their texts. Problems of at most DEALT responses (or most, if that is more) are
    sorted where they are grouped, so their rows are moved once. Only rows of the larger ones are dealt by ranges of problem
    and response (under path, by default in the shared folder) to find their parts, so that no task gets all texts of one.
    """
    rows = judged.select("problem_id", "response_idx", "input", "output", "score")
    large = oversized(judged, max(most, DEALT)).select(F.col("problem_id").alias("p"))
    same = F.col("problem_id").eqNullSafe(F.col("p"))
    some = not large.isEmpty()
    place = F.row_number().over(W.partitionBy("problem_id").orderBy("response_idx", "score", "output")) - 1
    parts = (rows.join(large, same, "left_anti") if some else rows).withColumn("part", F.floor(place / most))
    if some:
        spread = running(rows.join(large, same, "left_semi"), ["problem_id", "response_idx", "score", "output"], {"n": F.lit(1).cast("bigint")}, path or shared_path(judged.sparkSession, "grpo"))
        first = spread.groupBy(F.col("problem_id").alias("p")).agg(F.min("n").alias("first"))
        spread = spread.join(first, same).withColumn("part", F.floor((F.col("n") - F.col("first")) / most))
        parts = parts.unionByName(spread.select(*parts.columns))
    made = parts.groupBy("problem_id", "part").agg(F.min_by("input", "response_idx").alias("prompt"), F.sort_array(F.collect_list(F.struct("response_idx", "output", "score"))).alias("x"))
    return made.select("problem_id", F.col("part").cast("int").alias("part"), "prompt", F.transform("x", lambda r: r["output"]).alias("completions"), F.transform("x", lambda r: r["score"]).alias("scores"))


def oversized(judged: DataFrame, most: int = 1024) -> DataFrame:
    """(problem_id, responses) of the problems that to_grpo writes in several parts."""
    return judged.groupBy("problem_id").agg(F.count(F.lit(1)).alias("responses")).filter(F.col("responses") > most)
