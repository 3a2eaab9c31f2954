"""Request tables out, response tables in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgeset import schemas
from judgeset.config import ModelSpec
from judgeset.functions.text import generation_prompt, is_retryable, judge_prompt, stable_id
from judgeset.operators.models import assign_models, setting, with_cost

JUDGE_TEMPERATURE = 0.3


def _messages(system: Column, user: Column) -> Column:
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(say("system", system), say("user", user))


def _request(df: DataFrame, models: list[ModelSpec], system: str, user: Column, temperature: float | None = None) -> DataFrame:
    of = lambda field, kind: setting("model", models, field, kind).alias(field)
    df = df.select("*", of("endpoint", "string"), of("max_tokens", "int"), F.lit(temperature).alias("temperature") if temperature is not None else of("temperature", "double"))
    df = df.withColumn("messages", _messages(F.lit(system), user))
    return df.withColumn("body", F.to_json(F.struct("model", "messages", "max_tokens", "temperature")))


def generation_requests(tasks: DataFrame, models: list[ModelSpec], system_prompt: str, ordinal: str | None = None) -> DataFrame:
    """tasks (id, input) with model, messages, body (the chat request as JSON) and request_id.

    Without an ordinal column the model follows from a hash of the id, which needs no pass over the tasks.
    """
    df = assign_models(tasks, models, ordinal=ordinal, method="round_robin" if ordinal else "hash")
    return _request(df, models, system_prompt, generation_prompt("input")).withColumn("request_id", stable_id(F.lit("generate"), "id", "model"))


def judge_requests(samples: DataFrame, models: list[ModelSpec], num_judges: int, judge_system_prompt: str) -> DataFrame:
    """One request per sample and judge ordinal; the n-th judge of every sample has the n-th slot of the weights."""
    df = samples.withColumnRenamed("id", "sample_id").drop("model").withColumn("judge_ordinal", F.explode(F.sequence(F.lit(0), F.lit(num_judges - 1))))
    df = assign_models(df, models, ordinal="judge_ordinal")
    df = _request(df, models, judge_system_prompt, judge_prompt("input", "output", "answer"), JUDGE_TEMPERATURE)
    return df.withColumn("request_id", stable_id(F.lit("judge"), "sample_id", "judge_ordinal", "model"))


def match_responses(requests: DataFrame, responses: DataFrame, models: list[ModelSpec]) -> DataFrame:
    """requests with their responses (request_id, body as JSON; error, time_ms and at where known): content, tokens, cost
    and error, which is null where the response is good.

    A response fails with its own error if it has one, else if its body is no chat response, has no choice or a null
    content, or reports usage in part. Missing usage counts as no tokens; a missing model is the one that was asked.
    """
    known = lambda c, kind: (F.col(c) if c in responses.columns else F.lit(None)).cast(kind).alias(c)
    r = responses.select("request_id", "body", known("error", "string"), known("time_ms", "bigint"), known("at", "timestamp"))
    return read_responses(requests.drop("body").join(r, "request_id", "left"), models)


def read_responses(met: DataFrame, models: list[ModelSpec]) -> DataFrame:
    """The rows of match_responses from requests that stand with body, error, time_ms and at of their responses."""
    df = met.withColumnRenamed("error", "said").withColumn("r", F.from_json("body", schemas.CHAT_RESPONSE)).drop("body")
    usage = F.col("r.usage")
    content = F.try_element_at(F.col("r.choices"), F.lit(1))["message"]["content"]
    whole = usage.isNull() | (usage["prompt_tokens"].isNotNull() & usage["completion_tokens"].isNotNull() & usage["total_tokens"].isNotNull())
    found = F.when(F.col("said").isNotNull(), F.col("said")).when(F.col("r").isNull(), "no_response").when(F.col("content").isNull(), "no_content").when(~whole, "bad_usage")
    ok = df.withColumn("content", content).withColumn("error", found)
    counted = ok.withColumn("tokens_in", F.coalesce("r.usage.prompt_tokens", F.lit(0).cast("bigint"))).withColumn("tokens_out", F.coalesce("r.usage.completion_tokens", F.lit(0).cast("bigint"))).withColumn("total_tokens", F.coalesce("r.usage.total_tokens", F.lit(0).cast("bigint")))
    return with_cost(counted, models).withColumn("model", F.coalesce("r.model", "model")).drop("r", "said")


def ingest_responses(requests: DataFrame, responses: DataFrame, models: list[ModelSpec]) -> tuple[DataFrame, DataFrame]:
    """(ok, failed) of match_responses; failed has request_id and error. Both follow from the same join, so a caller who
    needs the two of a large table keeps what match_responses gives."""
    df = match_responses(requests, responses, models)
    return df.filter("error IS NULL").drop("error"), df.filter("error IS NOT NULL").select("request_id", "error")


def resolve_attempts(attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """One row per request: what its attempts (request_id, attempt, status, error, body) came to.

    The first success ends a request (parse_error if its body is no chat response), a terminal refusal ends it too;
    else it failed with the last error of the first max_retries attempts.
    """
    ok = F.col("status").between(200, 299)
    ends = ok | ~F.coalesce(is_retryable("status", "error"), F.lit(True))
    row = F.struct("attempt", "status", "error", "body")
    tried = attempts.filter(F.col("attempt") < max_retries)
    ended = tried.groupBy("request_id").agg(F.min_by(row, F.when(ends, F.col("attempt"))).alias("end"), F.max_by(row, "attempt").alias("last"), F.count(F.lit(1)).alias("attempts"))
    final = ended.withColumn("x", F.coalesce("end", "last"))
    parsed = F.try_element_at(F.from_json("x.body", schemas.CHAT_RESPONSE)["choices"], F.lit(1)).isNotNull()
    outcome = F.when(F.col("end").isNull(), "exhausted").when(~F.col("x.status").between(200, 299) | F.col("x.status").isNull(), "refused").when(parsed, "success").otherwise("parse_error")
    return final.select("request_id", outcome.alias("outcome"), F.col("x.status").alias("status"), F.col("x.error").alias("error"), (F.col("x.attempt") + 1).alias("attempts_used"))
