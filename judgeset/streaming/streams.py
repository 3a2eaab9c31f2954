"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from judgeset.functions.names import unused
from judgeset.functions.text import extract_answer, quality_flags
from judgeset.operators.dpo import MIN_GAP
from judgeset.operators.ledger import fold_ops
from judgeset.operators.sft import sft_filter
from judgeset.sources import files
from judgeset.sources.commit import commit_batch, commit_tables, new_try, read_committed
from judgeset.streaming.levels import LeveledTable


def stream_sft(judged: DataFrame, out_path: str, ledger_path: str, checkpoint: str, include_rejected: bool = False, once: bool = True) -> StreamingQuery:
    """Approved rows of a stream of judged samples (with problem_id, verdict, score, judge_cost_usd), committed batch
    by batch together with their operations; a repeated batch replaces itself. Operations are numbered by batch and by
    their rank within batch and problem, the same on every try."""

    def put(batch: DataFrame, batch_id: int) -> None:
        place = F.row_number().over(W.partitionBy("problem_id").orderBy(F.struct("score", "verdict", "judge_cost_usd"), F.to_json(F.struct("*"))))
        batch = batch.withColumn(rank := unused(batch, "rank"), place)
        none = lambda kind: F.lit(None).cast(kind)
        ops = batch.select(
            (F.lit(batch_id).cast("bigint") * F.lit(2**33) + F.col(rank)).alias("seq"), F.lit("judged").alias("type"), "problem_id", none("string").alias("model"),
            none("double").alias("cost"), "score", "verdict", F.col("judge_cost_usd").alias("judge_cost"), none("string").alias("output_json"), none("string").alias("reason"), none("timestamp").alias("at"),
        )
        commit_batch(sft_filter(batch.drop(rank), include_rejected), ops, out_path, ledger_path, batch_id)

    writer = judged.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def pair_updates(judged: DataFrame) -> DataFrame:
    """Best and worst response of each problem so far, for update mode: the state is one row per problem.

    judged has sample_id, problem_id, response_idx, score and model. The gap is left to the reader of the pairs,
    because a pair may come to meet it later.
    """
    rank = F.struct("score", (-F.col("response_idx")).alias("i"))
    row = F.struct("sample_id", "score", "model", "response_idx")
    return judged.groupBy("problem_id").agg(F.max_by(row, rank).alias("chosen"), F.min_by(row, rank).alias("rejected"), F.count(F.lit(1)).alias("responses"))


def final_pairs(judged: DataFrame, time: str, delay: str, window: str) -> DataFrame:
    """Best and worst response per problem and window of time, in append mode: a window is final once the watermark has
    passed it, and later responses to it are dropped."""
    rank = F.struct("score", (-F.col("response_idx")).alias("i"))
    row = F.struct("sample_id", "score", "model", "response_idx")
    return judged.withWatermark(time, delay).groupBy(F.window(time, window), "problem_id").agg(F.max_by(row, rank).alias("chosen"), F.min_by(row, rank).alias("rejected"), F.count(F.lit(1)).alias("responses"))


def ledger_updates(ops: DataFrame) -> DataFrame:
    """State of each problem so far, for update mode."""
    return fold_ops(ops)


def session_outcomes(judged: DataFrame, time: str, delay: str, gap: str) -> DataFrame:
    """Per problem and session of its responses, in append mode: best and worst response and their number.

    A session holds responses with no more than gap between one and the next; a response that lies between two sessions
    makes them one. A session is closed once the watermark has passed its end, which is gap after its last response, and
    later responses to it are dropped. Responses without a time have no session.
    """
    rank = F.struct("score", (-F.col("response_idx")).alias("i"))
    row = F.struct("sample_id", "score", "model", "response_idx")
    sessions = judged.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("session"), "problem_id")
    return sessions.agg(F.max_by(row, rank).alias("chosen"), F.min_by(row, rank).alias("rejected"), F.count(F.lit(1)).alias("responses"))


def stream_session_pairs(judged: DataFrame, time: str, delay: str, gap: str, folder: str, checkpoint: str, min_gap: float = MIN_GAP, once: bool = True) -> StreamingQuery:
    """One stream into two tables of folder, which each batch commits together: pairs (problem_id, session, chosen,
    rejected, responses) and insufficient (problem_id, session, responses, reason), the problems closed with fewer than
    two responses. Sessions whose scores are too close give neither. See read_sessions."""

    def put(batch: DataFrame, batch_id: int) -> None:
        closed = f"{folder}/closed/{new_try()}"
        batch.write.parquet(closed)  # the batch's state is read once for both tables
        batch = batch.sparkSession.read.schema(batch.schema).parquet(closed)
        pairs = batch.filter((F.col("responses") >= 2) & (F.col("chosen.score") - F.col("rejected.score") >= min_gap))
        few = batch.filter("responses < 2").select("problem_id", "session", "responses", F.lit("insufficient_samples").alias("reason"))
        commit_tables({f"{folder}/pairs": pairs, f"{folder}/insufficient": few}, f"{folder}/_manifest", batch_id)
        files.delete(batch.sparkSession, closed)

    writer = session_outcomes(judged, time, delay, gap).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


_SESSION = "session struct<start:timestamp,end:timestamp>"
_RESPONSE = "struct<sample_id:string,score:double,model:string,response_idx:{0}>"


def read_sessions(spark: SparkSession, folder: str, index: str = "int") -> tuple[DataFrame, DataFrame]:
    """(pairs, insufficient) as stream_session_pairs has committed them; index is the type of response_idx."""
    response = _RESPONSE.format(index)
    pairs = read_committed(spark, f"{folder}/pairs", f"{folder}/_manifest", f"problem_id string, {_SESSION}, chosen {response}, rejected {response}, responses bigint")
    few = read_committed(spark, f"{folder}/insufficient", f"{folder}/_manifest", f"problem_id string, {_SESSION}, responses bigint, reason string")
    return pairs.drop("batch_id"), few.drop("batch_id")


def stream_rows(samples: DataFrame, output: str = "output") -> DataFrame:
    """A stream of generated samples with their answer and the quality flags of their output; no state."""
    return samples.withColumn("answer", extract_answer(output)).withColumn("quality_flags", quality_flags(output))


def upsert(updates: DataFrame, path: str, key: str, checkpoint: str, fan: int = 8, once: bool = True) -> StreamingQuery:
    """Writes each batch of updated rows, whose keys are distinct, into the leveled table under path; latest() reads it."""
    table = LeveledTable(updates.sparkSession, path, key, fan)
    writer = updates.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: table.upsert(batch, batch_id) and None).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest(spark: SparkSession, path: str, key: str, schema: str | None = None) -> DataFrame:
    """The newest row of each key that upsert() wrote; schema is needed where there may be no batch yet."""
    return LeveledTable(spark, path, key).read(schema)
