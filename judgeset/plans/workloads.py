"""The two workloads: fine-tuning rows and preference pairs, from problems to trainer rows, batch by batch.

The model is the caller's: a function from an iterator of pandas frames (request_id, body) to one (request_id, body,
error; time_ms where it knows), run by mapInPandas. It is paid for and gives another answer each time, so its answers
are stored before anything else reads them, and only requests without an answer are put to it.

A run keeps everything in its folder: generated and judged (answer stores), and the tables rows (output), failed
(requests that failed, with their errors) and ledger (operations), which a batch commits together. Started again after a
crash, it removes what broken batches left, leaves out the problems that the ledger has as done, asks only what is
unanswered, and goes on with the rest; failed problems are tried again. Ids that repeat are one problem.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.config import EnsembleConfig, GenerationConfig, ModelSpec
from judgeset.functions.text import extract_answer, parse_verdict, score_or_default
from judgeset.operators import requests as R
from judgeset.operators.dpo import dpo_pairs, expand_responses
from judgeset.operators.judging import evaluate
from judgeset.operators.ledger import done_ids, one_each
from judgeset.operators.sft import judged_columns, sft_columns, sft_filter
from judgeset.sources import commit, files
from judgeset.sources.answers import AnswerStore, Batches, bucket_of

FAILURES = "request_id string, error string, problem_id string, stage string"
TABLES = ("rows", "failed", "ledger")
Keep = Callable[[DataFrame], DataFrame]


def generate(tasks: DataFrame, models: list[ModelSpec], system_prompt: str, fn: Batches, store: AnswerStore, ordinal: str | None = None, wanted: list[int] | None = None, keep: Keep = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(samples, failed) for tasks (id, problem_id, response_idx, input, metadata), whose problems lie in the wanted
    buckets of the store (all by default); failed has problem_id too. Tasks of one id and model share one answer. Both
    tables follow from one, which keep may write."""
    asked = R.generation_requests(tasks, models, system_prompt, ordinal)
    asked = asked if "bucket" in asked.columns else asked.withColumn("bucket", store.bucket("problem_id"))
    answers = store.answer(asked, fn, ["id", "problem_id", "response_idx", "input", "model", "metadata"], wanted)
    met = R.read_responses(answers, models).withColumn("output", F.col("content")).withColumn("answer", extract_answer("content"))
    met = keep(met.select("request_id", "error", "id", "problem_id", "response_idx", "input", "output", "answer", "model", F.col("at").alias("generated_at"), F.col("time_ms").alias("generation_time_ms"), "tokens_in", "tokens_out", "cost_usd", "metadata"))
    return met.filter("error IS NULL").drop("request_id", "error"), met.filter("error IS NOT NULL").select("request_id", "error", "problem_id")


def judge(samples: DataFrame, models: list[ModelSpec], num_judges: int, system_prompt: str, fn: Batches, store: AnswerStore, threshold: float, wanted: list[int] | None = None, keep: Keep = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(judge results, failed) for samples, each asked about num_judges times; failed has problem_id too. keep as in
    generate."""
    asked = R.judge_requests(samples.select("id", "problem_id", "input", "output", "answer"), models, num_judges, system_prompt).withColumn("bucket", store.bucket("problem_id"))
    answers = store.answer(asked, fn, ["sample_id", "problem_id", "judge_ordinal", "model"], wanted)
    scored = R.read_responses(answers, models).withColumn("score", score_or_default("content"))
    met = keep(scored.select("request_id", "error", "sample_id", "problem_id", "judge_ordinal", "score", parse_verdict("content", "score", threshold).alias("verdict"), F.col("content").alias("reasoning"), F.col("model").alias("judge_model"), F.col("at").alias("judged_at"), F.col("time_ms").alias("judge_time_ms"), F.col("cost_usd").alias("judge_cost_usd")))
    return met.filter("error IS NULL").drop("request_id", "error"), met.filter("error IS NOT NULL").select("request_id", "error", "problem_id")


def pending(problems: DataFrame, folder: str) -> DataFrame:
    """Problems that the folder's ledger does not have as approved, rejected or failed for good."""
    ledger = f"{folder}/ledger"
    problems = problems.filter("id IS NOT NULL")
    if not files.exists(problems.sparkSession, ledger):
        return problems
    return problems.join(done_ids(commit.read_ops(problems.sparkSession, ledger)), "id", "left_anti")


def failures(spark: SparkSession, folder: str) -> DataFrame:
    """What failed in the committed batches of the runs over folder, whether or not it was made good later."""
    return commit.read_committed(spark, f"{folder}/failed", commit.manifest_of(f"{folder}/ledger"), FAILURES)


_OPS = ("model string", "cost double", "score double", "verdict string", "judge_cost double", "reason string", "at timestamp")


def _ops(df: DataFrame, kind: str, place: int, **known) -> DataFrame:
    """One operation per problem of df. place orders the kinds of operations inside a batch."""
    columns = [(known[c] if c in known else F.lit(None)).cast(t).alias(c) for c, t in (x.split() for x in _OPS)]
    return df.select("problem_id", F.lit(kind).alias("type"), F.lit(place).alias("place"), *columns)


class _Run:
    """One run over a folder: its batches of whole buckets, their tables on the way, and their commits."""

    def __init__(self, problems: DataFrame, folder: str, batches: int, buckets: int, every: int, order: str | None):
        if not 1 <= batches <= buckets:
            raise ValueError("a run has as many batches as it has buckets at most")
        self.spark, self.folder, self.number, self.buckets = problems.sparkSession, folder, batches, buckets
        self.generated, self.judged = (AnswerStore(self.spark, f"{folder}/{name}", buckets, every) for name in ("generated", "judged"))
        self.manifest = commit.manifest_of(f"{folder}/ledger")
        self.recovered = commit.recover(self.spark, [f"{folder}/{t}" for t in TABLES], self.manifest)
        self.problems = one_each(problems, order)

    def batches(self) -> Iterator[tuple[int, list[int], DataFrame]]:
        """(batch id, its buckets, its problems) of what is still to be done."""
        done = self.spark.read.schema(commit.MANIFEST).json(self.manifest).agg(F.max("batch_id")).first()[0] if files.exists(self.spark, self.manifest) else None
        left = pending(self.problems, self.folder).withColumn("bucket", bucket_of("id", self.buckets))
        # the ledger grows while the batches run; a bucket is one file, however many tasks read the problems
        left.repartitionById(self.buckets, F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/pending")
        left = self.spark.read.schema(left.schema).parquet(f"{self.folder}/pending")
        for k in range(self.number):
            wanted = list(range(k, self.buckets, self.number))
            yield (-1 if done is None else done) + 1 + k, wanted, left.filter(F.col("bucket").isin(wanted))

    def keep(self, df: DataFrame, name: str = "answers") -> DataFrame:
        """df written once, so that the tables of a batch that follow from it read it instead of making it again."""
        path = f"{self.folder}/work/{name}-{commit.new_try()}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self, rows: DataFrame, ops: DataFrame, failed: DataFrame, batch_id: int) -> None:
        ops = ops.withColumn("seq", F.lit(batch_id).cast("bigint") * 16 + F.col("place")).withColumn("output_json", F.lit(None).cast("string")).drop("place")
        commit.commit_tables({f"{self.folder}/{name}": df for name, df in zip(TABLES, (rows, failed, ops), strict=True)}, self.manifest, batch_id)
        files.delete(self.spark, f"{self.folder}/work")

    def rows(self, schema) -> DataFrame:
        return commit.read_committed(self.spark, f"{self.folder}/rows", self.manifest, schema).drop("batch_id")


def _failed(failed: DataFrame, stage: str) -> DataFrame:
    return failed.select("request_id", "error", "problem_id", F.lit(stage).alias("stage"))


def run_sft(problems: DataFrame, generators: list[ModelSpec], judges: list[ModelSpec], prompts: tuple[str, str], ask: Batches, review: Batches, folder: str, gen: GenerationConfig = GenerationConfig(), cfg: EnsembleConfig = EnsembleConfig(), batches: int = 1, buckets: int = 64, every: int = 64, order: str | None = None) -> DataFrame:
    """Problems to approved fine-tuning rows, committed in so many batches; see failures() for what failed.

    A problem without a sample fails in generation, a sample without any judge's answer in judgment. Of rows that share
    an id one is the problem: the last by the column order, else the greatest of them. buckets must stay the same over
    all runs of a folder; a task of the model stages asks about every requests. An empty table of problems gives no rows.
    """
    run, schema = _Run(problems, folder, batches, buckets, every, order), None
    for batch_id, wanted, part in run.batches():
        tasks = part.withColumn("problem_id", F.col("id")).withColumn("response_idx", F.lit(0))
        samples, unmade = generate(tasks, generators, prompts[0], ask, run.generated, wanted=wanted, keep=run.keep)
        results, unjudged = judge(samples, judges, cfg.num_judges if cfg.enabled else 1, prompts[1], review, run.judged, gen.approval_threshold, wanted, run.keep)
        scores = judged_columns(evaluate(results.drop("problem_id", "judged_at"), cfg, judges))
        scored = run.keep(samples.join(scores, "id", "left"), "scored")  # all tables of the batch follow from its rows
        verdicts, silent = scored.filter("num_judges IS NOT NULL"), scored.filter("num_judges IS NULL").select("problem_id").distinct()
        ops = (
            _ops(samples.select("problem_id", "model", "cost_usd", "generated_at"), "generated", 0, model=F.col("model"), cost=F.col("cost_usd"), at=F.col("generated_at"))
            .unionByName(_ops(verdicts, "judged", 1, score=F.col("score"), verdict=F.col("verdict"), judge_cost=F.col("judge_cost_usd")))
            .unionByName(_ops(unmade.select("problem_id").distinct(), "failed", 2, reason=F.lit("generation_failed")))
            .unionByName(_ops(silent, "failed", 2, reason=F.lit("judgment_failed")))
        )
        rows = sft_columns(sft_filter(verdicts, gen.include_rejected), gen.track_costs)
        schema = rows.schema
        run.commit(rows, ops, _failed(unmade, "generation").unionByName(_failed(unjudged, "judgment")), batch_id)
    return run.rows(schema)


def run_dpo(problems: DataFrame, generators: list[ModelSpec], judges: list[ModelSpec], prompts: tuple[str, str], ask: Batches, review: Batches, folder: str, n: int = 3, gen: GenerationConfig = GenerationConfig(), cfg: EnsembleConfig = EnsembleConfig(), batches: int = 1, buckets: int = 64, every: int = 64, order: str | None = None) -> DataFrame:
    """Problems to preference pairs of n responses each, committed in so many batches. Verdicts play no part: a problem
    is approved if it has a pair, rejected if its scores are too close, and failed with fewer than two judged responses.
    Repeated ids, buckets, every and order as in run_sft."""
    run, schema = _Run(problems, folder, batches, buckets, every, order), None
    for batch_id, wanted, part in run.batches():
        samples, unmade = generate(expand_responses(part, n), generators, prompts[0], ask, run.generated, ordinal="response_idx", wanted=wanted, keep=run.keep)
        results, unjudged = judge(samples, judges, cfg.num_judges if cfg.enabled else 1, prompts[1], review, run.judged, gen.approval_threshold, wanted, run.keep)
        scores = evaluate(results.drop("problem_id", "judged_at"), cfg, judges).select("sample_id", "score", "num_judges", "judge_cost_usd")
        made = samples.select(F.col("id").alias("sample_id"), "problem_id", "response_idx", "model", "output", "cost_usd", "generated_at")
        scored = run.keep(made.join(scores, "sample_id", "left"), "scored")
        pairs = run.keep(dpo_pairs(scored.filter("num_judges IS NOT NULL"), part), "pairs")
        costs = scored.groupBy("problem_id").agg(F.count(F.lit(1)).alias("made"), F.sum("cost_usd").alias("cost_usd"), F.max("generated_at").alias("at"), F.count("num_judges").alias("n"), F.sum("judge_cost_usd").alias("judge_cost_usd"))
        of = run.keep(part.select(F.col("id").alias("problem_id")).join(costs, "problem_id", "left").join(pairs.select("problem_id", "chosen_score"), "problem_id", "left"), "problems")
        enough = F.coalesce("n", F.lit(0)) >= 2
        reason = F.when(F.coalesce("made", F.lit(0)) < 2, "generation_failed").otherwise("judgment_failed")
        ops = (
            _ops(of.filter("made > 0"), "generated", 0, cost=F.col("cost_usd"), at=F.col("at"))
            .unionByName(_ops(of.filter(enough), "judged", 1, score=F.col("chosen_score"), verdict=F.when(F.col("chosen_score").isNotNull(), "approve").otherwise("reject"), judge_cost=F.col("judge_cost_usd")))
            .unionByName(_ops(of.filter(~enough), "failed", 2, reason=reason))
        )
        schema = pairs.schema
        run.commit(pairs, ops, _failed(unmade, "generation").unionByName(_failed(unjudged, "judgment")), batch_id)
    return run.rows(schema)


def replay(reply: Callable[[str], tuple[str | None, str | None]]) -> Batches:
    """In place of a model: reply gives (body, error) for a request's body, always the same."""

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [reply(body) for body in batch["body"]]
            yield pd.DataFrame({"request_id": batch["request_id"], "body": [b for b, _ in got], "error": [e for _, e in got]}, dtype="object")

    return fn
