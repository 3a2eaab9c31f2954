"""Queries of the library's own operators over the given tables, with their oracle SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from judgeset import fixtures as X
from judgeset.config import EnsembleConfig, ModelSpec
from judgeset.functions import text as TX
from judgeset.operators import curate, dpo, exports, judging, ledger, models, ratelimit, requests, sft, stats
from judgeset.plans import workloads
from judgeset.sources import commit, jsonl
from judgeset.sources.files import shared_path as _shared
from judgeset.streaming import levels, streams

GENERATORS = [ModelSpec("model-0", endpoint="alpha", weight=2, input_price_per_1m=0.5, output_price_per_1m=1.5), ModelSpec("model-1", endpoint="beta", weight=1, input_price_per_1m=0.25, output_price_per_1m=2.0)]
JUDGES = [ModelSpec("judge-0", weight=2), ModelSpec("judge-1", weight=1), ModelSpec("judge-2", weight=0)]
ENSEMBLE = EnsembleConfig(enabled=True)
THRESHOLD = 0.85

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Registers the decorated (spark, sf_dir) function under its name, with sql as its oracle."""

    def put(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return put


# --- text -------------------------------------------------------------------------------------------------------------

# The markers, patterns and limits that the column functions must match, as SQL literals.
_ANSWER = """CASE WHEN regexp_matches(output, '<answer>([^\\n]*?)</answer>') THEN trim(regexp_extract(output, '<answer>([^\\n]*?)</answer>', 1))
  WHEN regexp_matches(output, '##\\s*Answer\\s*\\n([^\\n]*?)(?:\\n##|\\z)') THEN trim(regexp_extract(output, '##\\s*Answer\\s*\\n([^\\n]*?)(?:\\n##|\\z)', 1))
  ELSE left(regexp_replace(list_filter(string_split(output, chr(10) || chr(10)), lambda x: regexp_replace(x, '\\s+', '', 'g') <> '')[-1], '^\\s+|\\s+$', '', 'g'), 500) END"""
_TRIMMED = "regexp_replace(output, '^\\s+|\\s+$', '', 'g')"
_FLAGS = f"""({_TRIMMED} <> '' AND (right({_TRIMMED}, 1) NOT IN ('.', '!', '?', ')', ']', '}}', '"', '''', '>', '*') OR suffix({_TRIMMED}, '...'))) AS truncated,
  (contains(output, '<answer>') OR contains(output, '</answer>') OR contains(output, '## Answer') OR contains(output, '**Answer**') OR contains(output, '\\boxed{{')) AS has_answer_tags,
  (contains(output, '## OBSERVE') OR contains(output, '### OBSERVE') OR contains(output, 'K_i') OR contains(output, 'B_i') OR contains(output, '<reasoning>') OR contains(output, 'Step 1') OR contains(output, 'First,') OR contains(output, 'Let''s think') OR contains(output, 'Let me')) AS has_reasoning,
  (contains(output, 'Wait') OR contains(output, 'Actually') OR contains(output, 'Let me reconsider') OR contains(output, 'I made a mistake') OR contains(output, 'Correction:') OR contains(output, 'On second thought')) AS self_correction,
  CAST(CASE WHEN contains(output, '<answer>') THEN strlen(left(output, strpos(output, '<answer>') - 1)) WHEN contains(output, '## Answer') THEN strlen(left(output, strpos(output, '## Answer') - 1)) ELSE strlen(output) END AS BIGINT) AS reasoning_length"""


@query(f"SELECT doc_id, {_ANSWER} AS answer FROM ({X.OUTPUTS}) o")
def extract_answer(spark: SparkSession, d: str) -> DataFrame:
    return X.frame(spark, d, X.OUTPUTS).select("doc_id", TX.extract_answer("output").alias("answer"))


@query(f"SELECT doc_id, {_FLAGS} FROM ({X.OUTPUTS}) o")
def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    return X.frame(spark, d, X.OUTPUTS).select("doc_id", TX.quality_flags("output").alias("q")).select("doc_id", "q.*")


def _score_sql(c: str) -> str:
    def limited(p: str) -> str:
        return f"CASE WHEN regexp_matches({c}, '{p}') THEN least(1.0::DOUBLE, greatest(0.0::DOUBLE, try_cast(regexp_extract({c}, '{p}', 1) AS DOUBLE))) END"

    patterns = ["[Ss]core[:\\s]+(\\d+\\.?\\d*)", "\\*\\*[Ss]core\\*\\*[:\\s]+(\\d+\\.?\\d*)", "[Oo]verall\\s+[Ss]core[:\\s]+(\\d+\\.?\\d*)"]
    return "coalesce(" + ", ".join(limited(p) for p in patterns) + f", CASE WHEN regexp_matches({c}, '(0\\.\\d+|1\\.0)') THEN try_cast(regexp_extract({c}, '(0\\.\\d+|1\\.0)', 1) AS DOUBLE) END)"


def _verdict_sql(c: str, score: str) -> str:
    return f"CASE WHEN contains(upper({c}), 'APPROVE') AND NOT contains(upper({c}), 'NOT APPROVE') THEN 'approve' WHEN contains(upper({c}), 'REJECT') THEN 'reject' WHEN {score} >= {THRESHOLD} THEN 'approve' ELSE 'reject' END"


_VERDICT = _verdict_sql("reply", "coalesce(" + _score_sql("reply") + ", 0.5)")


@query(f"SELECT doc_id, {_score_sql('reply')} AS score FROM ({X.REPLIES}) r")
def parse_score(spark: SparkSession, d: str) -> DataFrame:
    return X.frame(spark, d, X.REPLIES).select("doc_id", TX.parse_score("reply").alias("score"))


@query(f"SELECT doc_id, {_VERDICT} AS verdict FROM ({X.REPLIES}) r")
def parse_verdict(spark: SparkSession, d: str) -> DataFrame:
    return X.frame(spark, d, X.REPLIES).select("doc_id", TX.parse_verdict("reply", TX.score_or_default("reply"), THRESHOLD).alias("verdict"))


_J = "CAST(json_extract_string(reply, '$.scores.{}') AS DOUBLE)"
_LOW = "least(" + ", ".join(_J.format(k) for k in ("completeness", "accuracy", "reasoning_validity", "answer_correctness", "clarity")) + ")"
_OVERALL = "CAST(json_extract_string(reply, '$.overall_score') AS DOUBLE)"


@query(f"SELECT doc_id, CASE WHEN doc_id % 10 <> 4 THEN NULL WHEN {_OVERALL} >= 0.85 AND {_LOW} >= 0.7 THEN 'approve' WHEN {_OVERALL} >= 0.6 AND {_J.format('answer_correctness')} >= 0.8 THEN 'needs_revision' ELSE 'reject' END AS verdict FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 4 THEN reply END AS reply FROM ({X.REPLIES}) r) j")
def rubric_verdict(spark: SparkSession, d: str) -> DataFrame:
    return X.frame(spark, d, X.REPLIES).withColumn("r", TX.parse_rubric("reply")).select("doc_id", TX.rubric_verdict(F.col("r")).alias("verdict"))


# --- judging ----------------------------------------------------------------------------------------------------------


def _ensemble_sql(strategy: str, source: str = X.JUDGE_RESULTS) -> str:
    w = "CASE judge_model WHEN 'judge-0' THEN 2.0 WHEN 'judge-1' THEN 1.0 WHEN 'judge-2' THEN 0.0 ELSE 1.0 END"
    score = {
        "median": "CASE WHEN n % 2 = 0 THEN (ss[CAST(n / 2 AS BIGINT)] + ss[CAST(n / 2 AS BIGINT) + 1]) / 2 ELSE ss[CAST((n + 1) / 2 AS BIGINT)] END",
        "average": "list_sum(s) / n",
        "weightedaverage": "CASE WHEN list_sum(w) > 0 THEN list_sum(list_transform(list_zip(s, w), lambda x: x[1] * x[2])) / list_sum(w) ELSE list_sum(s) / n END",
    }[strategy]
    return f"""SELECT sample_id, round(score, 9) AS score, verdict,
  CASE WHEN std >= 0.15 THEN 'low' WHEN (verdict = 'approve' AND approvals = n) OR (verdict = 'reject' AND approvals = 0) THEN 'high' ELSE 'medium' END AS confidence,
  round(std, 9) AS score_std_dev, CAST(n AS INT) AS num_judges, reasoning, judge_models, CAST(judge_time_ms AS BIGINT) AS judge_time_ms, round(cost, 9) AS judge_cost_usd, list_transform(s, lambda x: round(x, 9)) AS individual_scores
FROM (SELECT *, {score} AS score, CASE WHEN approvals > n // 2 THEN 'approve' ELSE 'reject' END AS verdict,
    sqrt(list_sum(list_transform(s, lambda x: (x - list_sum(s) / n) * (x - list_sum(s) / n))) / n) AS std
  FROM (SELECT sample_id, count(*) AS n, list(score ORDER BY judge_ordinal) AS s, list_sort(list(score)) AS ss, list({w} ORDER BY judge_ordinal) AS w,
      count(*) FILTER (WHERE verdict = 'approve') AS approvals, arg_min(reasoning, judge_ordinal) AS reasoning, string_agg(judge_model, ',' ORDER BY judge_ordinal) AS judge_models,
      max(judge_time_ms) AS judge_time_ms, sum(judge_cost_usd) AS cost
    FROM ({source}) j GROUP BY sample_id) g) h"""


def _rounded(df: DataFrame) -> DataFrame:
    cols = {c: F.round(c, 9) for c in ("score", "score_std_dev", "judge_cost_usd")}
    return df.withColumns(cols).withColumn("individual_scores", F.transform("individual_scores", lambda x: F.round(x, 9)))


def _ensemble(spark: SparkSession, d: str, strategy: str) -> DataFrame:
    return _rounded(judging.ensemble(X.frame(spark, d, X.JUDGE_RESULTS), EnsembleConfig(enabled=True, strategy=strategy), JUDGES))


@query(_ensemble_sql("median"))
def ensemble_median(spark: SparkSession, d: str) -> DataFrame:
    return _ensemble(spark, d, "median")


@query(_ensemble_sql("average"))
def ensemble_average(spark: SparkSession, d: str) -> DataFrame:
    return _ensemble(spark, d, "average")


@query(_ensemble_sql("weightedaverage"))
def ensemble_weighted(spark: SparkSession, d: str) -> DataFrame:
    return _ensemble(spark, d, "weightedaverage")


_SINGLE = "SELECT sample_id, round(score, 9) AS score, verdict, 'high' AS confidence, 0.0::DOUBLE AS score_std_dev, CAST(1 AS INT) AS num_judges, reasoning, judge_model AS judge_models, judge_time_ms, round(judge_cost_usd, 9) AS judge_cost_usd, [round(score, 9)] AS individual_scores FROM (" + X.JUDGE_RESULTS + ") j WHERE judge_ordinal = 0"


@query(_SINGLE)
def single_judge(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(judging.evaluate(X.frame(spark, d, X.JUDGE_RESULTS), EnsembleConfig(enabled=False)))


@query(f"WITH r AS ({X.JUDGE_RESULTS}) {_SINGLE.replace('(' + X.JUDGE_RESULTS + ')', 'r')} AND (score < 0.2 OR score > 0.6) UNION ALL SELECT * FROM ({_ensemble_sql('median', 'SELECT * FROM r WHERE sample_id IN (SELECT sample_id FROM r WHERE judge_ordinal = 0 AND score BETWEEN 0.2 AND 0.6)')}) e")
def hierarchical_route(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(judging.evaluate(X.frame(spark, d, X.JUDGE_RESULTS), EnsembleConfig(enabled=True, hierarchical=True, uncertain_range=(0.2, 0.6)), JUDGES))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN 'model-0' ELSE 'model-1' END AS model FROM orders")
def weighted_models(spark: SparkSession, d: str) -> DataFrame:
    return models.assign_models(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey"), GENERATORS, ordinal="o_orderkey")


@query("SELECT CASE WHEN i % 3 < 2 THEN 'model-0' ELSE 'model-1' END AS model, count(*) AS n FROM (SELECT row_number() OVER () - 1 AS i FROM orders) o GROUP BY 1")
def weighted_models_numbered(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each model where the table has no ordinal column and its rows are numbered first."""
    return models.assign_models(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey"), GENERATORS, key="o_orderkey").groupBy("model").agg(F.count(F.lit(1)).alias("n"))


#: Weights as large as token budgets; the second model has none.
HEAVY = [ModelSpec("a", weight=10**9), ModelSpec("b", weight=0), ModelSpec("c", weight=2 * 10**9), ModelSpec("d", weight=1)]


@query("SELECT o_custkey, n, CASE WHEN slot < 1000000000 THEN 'a' WHEN slot < 3000000000 THEN 'c' ELSE 'd' END AS model FROM (SELECT *, (row_number() OVER (ORDER BY o_custkey) - 1) * 700000001 % 3000000001 AS slot FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) g) o")
def weighted_models_grouped(spark: SparkSession, d: str) -> DataFrame:
    """Models of an aggregated table, whose rows are numbered by their keys, under weights of thousands of millions."""
    customers = spark.read.parquet(f"{d}/orders.parquet").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    numbered, name = models.with_ordinal(customers, "i", key="o_custkey")
    return models.assign_models(numbered.withColumn("o", F.col(name) * 700000001), HEAVY, ordinal="o").select("o_custkey", "n", "model")


_COST = "(tokens_in / 1e6::DOUBLE) * CASE model WHEN 'model-0' THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END + (tokens_out / 1e6::DOUBLE) * CASE model WHEN 'model-0' THEN 1.5::DOUBLE ELSE 2.0::DOUBLE END"


@query(f"SELECT sample_id, round({_COST}, 12) AS cost_usd FROM ({X.JUDGED}) s")
def token_cost(spark: SparkSession, d: str) -> DataFrame:
    return models.with_cost(X.frame(spark, d, X.JUDGED), GENERATORS).select("sample_id", F.round("cost_usd", 12).alias("cost_usd"))


@query(f"SELECT sample_id, 'model-0' AS model, round((tokens_in / 1e6::DOUBLE) * 0.5::DOUBLE + (tokens_out / 1e6::DOUBLE) * 1.5::DOUBLE, 12) AS cost_usd FROM ({X.JUDGED}) s")
def cheapest_model(spark: SparkSession, d: str) -> DataFrame:
    """What every sample would cost with the cheapest model."""
    samples = X.frame(spark, d, X.JUDGED).withColumn("model", F.lit(models.cheapest_model(GENERATORS).id))
    return models.with_cost(samples, GENERATORS).select("sample_id", "model", F.round("cost_usd", 12).alias("cost_usd"))


@query(f"SELECT endpoint, count(*) AS requests, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out, round(sum({_COST}), 9) AS cost_usd, CAST(sum(CAST(floor(({_COST}) * 1e6::DOUBLE) AS BIGINT)) AS BIGINT) AS cost_micros FROM ({X.JUDGED}) s GROUP BY endpoint")
def usage_by_endpoint(spark: SparkSession, d: str) -> DataFrame:
    return stats.usage_by_endpoint(models.with_cost(X.frame(spark, d, X.JUDGED), GENERATORS)).withColumn("cost_usd", F.round("cost_usd", 9))


@query(f"SELECT model, count(*) AS samples, round(sum({_COST}), 9) AS cost_usd FROM ({X.JUDGED}) s GROUP BY model")
def cost_by_model(spark: SparkSession, d: str) -> DataFrame:
    return stats.cost_by_model(models.with_cost(X.frame(spark, d, X.JUDGED), GENERATORS)).withColumn("cost_usd", F.round("cost_usd", 9))


@query(f"SELECT endpoint, model, CAST(grouping(endpoint) * 2 + grouping(model) AS INT) AS level, count(*) AS requests, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out, round(sum({_COST}), 6) AS cost_usd FROM ({X.JUDGED}) s GROUP BY ROLLUP (endpoint, model)")
def usage_rollup(spark: SparkSession, d: str) -> DataFrame:
    return stats.usage_rollup(models.with_cost(X.frame(spark, d, X.JUDGED), GENERATORS)).withColumn("cost_usd", F.round("cost_usd", 6))


#: Models whose endpoints repeat; their order is that of their first model.
ROUTES = [ModelSpec(f"route-{i}", endpoint=e) for i, e in enumerate(("zeta", "alpha", "zeta", "mid", "alpha"))]


@query("SELECT CAST(o_orderkey % 5 AS INT) AS route, CAST(CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS INT) AS place, CAST(3 AS INT) AS endpoints, count(*) AS orders FROM orders GROUP BY o_orderkey % 5")
def endpoint_places(spark: SparkSession, d: str) -> DataFrame:
    """Orders by the place of their route's endpoint among the endpoints in use."""
    places = {e: i for i, e in enumerate(models.endpoints(ROUTES))}
    known = spark.createDataFrame([(i, places[m.endpoint], len(models.endpoints(ROUTES))) for i, m in enumerate(ROUTES)], "route int, place int, endpoints int")
    orders = spark.read.parquet(f"{d}/orders.parquet").select((F.col("o_orderkey") % 5).cast("int").alias("route"))
    return orders.join(F.broadcast(known), "route").groupBy("route", "place", "endpoints").agg(F.count(F.lit(1)).alias("orders"))


@query(f"SELECT endpoint, count(*) AS samples FROM ({X.JUDGED}) s GROUP BY endpoint")
def sample_endpoints(spark: SparkSession, d: str) -> DataFrame:
    """Samples of each configured endpoint, by the endpoint of the model that made them."""
    of = {m.id: m.endpoint for m in GENERATORS}
    known = spark.createDataFrame([(m, e) for m, e in of.items() if e in models.endpoints(GENERATORS)], "model string, by string")
    return X.frame(spark, d, X.JUDGED).join(F.broadcast(known), "model").groupBy(F.col("by").alias("endpoint")).agg(F.count(F.lit(1)).alias("samples"))


# --- pairs ------------------------------------------------------------------------------------------------------------

_PAIRS = f"""SELECT sha256(g.problem_id) AS id, g.problem_id, p.input, c.output AS chosen, r.output AS rejected, g.hi AS chosen_score, g.lo AS rejected_score, c.model AS chosen_model, r.model AS rejected_model, p.metadata
FROM (SELECT problem_id, max(score) AS hi, min(score) AS lo, arg_max(response_idx, (score, -response_idx)) AS ci, arg_min(response_idx, (score, -response_idx)) AS ri FROM ({X.JUDGED}) j GROUP BY problem_id HAVING count(*) >= 2) g
JOIN ({X.JUDGED}) c ON c.problem_id = g.problem_id AND c.response_idx = g.ci JOIN ({X.JUDGED}) r ON r.problem_id = g.problem_id AND r.response_idx = g.ri
JOIN ({X.PROBLEMS}) p ON p.id = g.problem_id WHERE g.hi - g.lo >= 0.1::DOUBLE"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return dpo.dpo_pairs(X.frame(spark, d, X.JUDGED), X.frame(spark, d, X.PROBLEMS))


@query(_PAIRS)
def dpo_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)


@query(f"SELECT problem_id, response_idx, CAST(row_number() OVER (PARTITION BY problem_id ORDER BY score DESC, response_idx) AS INT) AS rank FROM ({X.JUDGED}) j")
def preference_rank(spark: SparkSession, d: str) -> DataFrame:
    return dpo.preference_rank(X.frame(spark, d, X.JUDGED)).select("problem_id", "response_idx", "rank")


@query(f"SELECT p.id AS problem_id, CASE WHEN coalesce(g.n, 0) < 2 THEN 'insufficient_samples' ELSE 'judgment_failed' END AS reason FROM ({X.PROBLEMS}) p LEFT JOIN (SELECT problem_id, count(*) AS n, count(*) FILTER (WHERE verdict = 'approve') AS j FROM ({X.JUDGED}) x GROUP BY problem_id) g ON g.problem_id = p.id WHERE coalesce(g.n, 0) < 2 OR coalesce(g.j, 0) < 2")
def insufficient_samples(spark: SparkSession, d: str) -> DataFrame:
    judged = X.frame(spark, d, X.JUDGED)
    return dpo.insufficient(X.frame(spark, d, X.PROBLEMS).withColumnRenamed("id", "problem_id"), judged, judged.filter("verdict = 'approve'"))


@query(f"SELECT id || '_' || CAST(i AS VARCHAR) AS id, id AS problem_id, CAST(i AS INT) AS response_idx FROM ({X.PROBLEMS}) p, range(0, 3) AS r(i)")
def response_expansion(spark: SparkSession, d: str) -> DataFrame:
    return dpo.expand_responses(X.frame(spark, d, X.PROBLEMS), 3).select("id", "problem_id", "response_idx")


# --- fine-tuning rows -------------------------------------------------------------------------------------------------


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return X.frame(spark, d, X.SCORED)


def _sft(spark: SparkSession, d: str, include_rejected: bool = False) -> DataFrame:
    s = _scored(spark, d)
    samples = s.withColumn("answer", TX.extract_answer("output")).withColumn("generation_time_ms", F.lit(1).cast("bigint")).withColumn("metadata", F.lit(None).cast("string"))
    judged = s.select(F.col("id").alias("sample_id"), "score", "verdict", F.lit("high").alias("confidence"), F.lit(0.0).alias("score_std_dev"), "num_judges", F.array("score").alias("individual_scores"), F.lit("ok").alias("reasoning"), F.lit("judge-0").alias("judge_models"), "judge_cost_usd")
    return sft.sft_rows(samples.drop("score", "verdict", "num_judges", "judge_cost_usd"), judged, include_rejected)


_SFT = f"""SELECT sha256(id) AS id, input, output, {_ANSWER} AS answer, model, score, problem_id, tokens_in, tokens_out, 'ok' AS judge_reasoning, CAST(1 AS BIGINT) AS generation_time_ms, 'judge-0' AS judge_model, verdict,
  {_FLAGS}, CASE WHEN num_judges > 1 THEN 'high' END AS judge_confidence, CASE WHEN num_judges > 1 THEN 0.0::DOUBLE END AS score_std_dev, CASE WHEN num_judges > 1 THEN num_judges END AS num_judges,
  CASE WHEN num_judges > 1 THEN [score] END AS individual_scores, cost_usd + judge_cost_usd AS cost_usd, CAST(NULL AS VARCHAR) AS metadata FROM ({X.SCORED}) s WHERE verdict = 'approve'"""


def _flat(rows: DataFrame) -> DataFrame:
    """All columns, the quality flags one by one."""
    return rows.select(*[c for c in rows.columns if c != "quality_flags"], "quality_flags.*")


@query(_SFT)
def sft_rows(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_sft(spark, d))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def judge_failures(spark: SparkSession, d: str) -> DataFrame:
    return sft.failed_requests(spark.read.parquet(f"{d}/documents.parquet").select("doc_id"), spark.read.parquet(f"{d}/labels.parquet"), "doc_id")


_FLAGGED = f"SELECT s.*, {_FLAGS} FROM ({X.SCORED}) s"


@query(f"SELECT sha256(id) AS id, score FROM ({_FLAGGED}) f WHERE verdict = 'approve' AND score >= 0.9 AND NOT truncated AND has_reasoning")
def high_confidence(spark: SparkSession, d: str) -> DataFrame:
    return curate.high_confidence(_sft(spark, d)).select("id", "score")


@query(f"SELECT sha256(id) AS id, CASE WHEN truncated THEN 'low_i' WHEN score >= 0.9 AND has_reasoning THEN 'high_k' WHEN score >= 0.7 THEN 'med_b' ELSE 'low_i' END AS tier FROM ({_FLAGGED}) f")
def confidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    return curate.confidence_tier(_sft(spark, d, True)).select("id", "tier")


@query(f"SELECT sha256(id) AS id, CASE WHEN truncated THEN 'low_i' WHEN score >= 0.9 AND has_reasoning THEN 'high_k' WHEN score >= 0.7 THEN 'med_b' ELSE 'low_i' END AS tier FROM ({_FLAGGED}) f WHERE truncated OR score < 0.7 OR (score >= 0.9 AND has_reasoning)")
def tier_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The best and the lowest tier, read from their folders."""
    path = _shared(spark, "tiers")
    curate.write_tiers(_sft(spark, d, True), path)
    return curate.read_tier(spark, path, "high_k", "low_i").select("id", "tier")


_RATES = "total_approved / 3600.0::DOUBLE * 3600.0::DOUBLE AS throughput_per_hour, CASE WHEN total_judged = 0 THEN 0.0::DOUBLE ELSE total_approved / total_judged::DOUBLE END AS approval_rate, 3600.0::DOUBLE AS runtime_secs"


@query(f"SELECT *, {_RATES} FROM (SELECT (SELECT count(*) FROM documents) AS total_problems, (SELECT count(*) FROM documents) AS total_generated, count(*) AS total_judged, count(*) FILTER (WHERE verdict = 'approve') AS total_approved, count(*) FILTER (WHERE verdict <> 'approve') AS total_rejected, coalesce(sum(cost_usd), 0)::DOUBLE AS generation_cost_usd, coalesce(sum(judge_cost_usd), 0)::DOUBLE AS judge_cost_usd FROM ({X.SCORED}) s) t")
def run_stats_sft(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id")
    return stats.run_stats_sft(docs, docs, _scored(spark, d), 3600.0)


@query(f"SELECT total_problems, total_generated, total_judged, total_approved, g - total_approved AS total_rejected, round(generation_cost_usd, 6) AS generation_cost_usd, round(judge_cost_usd, 6) AS judge_cost_usd, {_RATES} FROM (SELECT (SELECT count(*) FROM orders) AS total_problems, count(*) AS total_generated, count(*) AS total_judged, (SELECT count(*) FROM ({_PAIRS}) p) AS total_approved, count(DISTINCT problem_id) AS g, sum({_COST}) AS generation_cost_usd, sum(judge_cost_usd) AS judge_cost_usd FROM ({X.JUDGED}) s) t")
def run_stats_dpo(spark: SparkSession, d: str) -> DataFrame:
    judged = models.with_cost(X.frame(spark, d, X.JUDGED), GENERATORS)
    out = stats.run_stats_dpo(X.frame(spark, d, X.PROBLEMS), judged, judged, _pairs(spark, d), 3600.0)
    return out.withColumn("generation_cost_usd", F.round("generation_cost_usd", 6)).withColumn("judge_cost_usd", F.round("judge_cost_usd", 6))


# --- ledger -----------------------------------------------------------------------------------------------------------

_LEDGER = f"""SELECT p.id, coalesce(f.status, 'pending') AS status, f.score, f.model, coalesce(f.gen_cost, 0) AS gen_cost, coalesce(f.judge_cost, 0) AS judge_cost, CAST(coalesce(f.retry_count, 0) AS INT) AS retry_count, f.retry_reason, f.updated_at
FROM ({X.LEDGER_PROBLEMS}) p LEFT JOIN (SELECT problem_id, arg_max(CASE WHEN type = 'generated' THEN 'generated' WHEN type = 'failed' THEN 'retrypending' WHEN verdict = 'approve' THEN 'approved' ELSE 'rejected' END, seq) AS status,
  arg_max(score, seq) FILTER (WHERE type = 'judged') AS score, arg_max(model, seq) FILTER (WHERE type = 'generated') AS model, arg_max(cost, seq) FILTER (WHERE type = 'generated') AS gen_cost,
  arg_max(judge_cost, seq) FILTER (WHERE type = 'judged') AS judge_cost, count(*) FILTER (WHERE type = 'failed') AS retry_count, arg_max(reason, seq) FILTER (WHERE type = 'failed') AS retry_reason, arg_max(o.at, seq) AS updated_at
  FROM ({X.OPS}) o GROUP BY problem_id) f ON f.problem_id = p.id"""


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    return ledger.fold_ledger(X.frame(spark, d, X.LEDGER_PROBLEMS), X.frame(spark, d, X.OPS))


@query(_LEDGER)
def ledger_fold(spark: SparkSession, d: str) -> DataFrame:
    return _ledger(spark, d)


@query(_LEDGER)
def ledger_compact(spark: SparkSession, d: str) -> DataFrame:
    """The same ledger from a snapshot and the operations after it."""
    ops = X.frame(spark, d, X.OPS)
    return ledger.compact(ledger.fold_ledger(X.frame(spark, d, X.LEDGER_PROBLEMS), ops.filter("seq <= 500")), ops, 500)


@query(_LEDGER)
def ledger_levels(spark: SparkSession, d: str) -> DataFrame:
    """The same ledger from partial folds of the log, added batch by batch and merged by levels."""
    ops, table = X.frame(spark, d, X.OPS), levels.ledger_table(spark, _shared(spark, "levels"), fan=3)
    for batch in range(7):
        levels.append_ops(table, ops.filter(F.col("seq") % 7 == batch), batch)
    return ledger.with_problems(X.frame(spark, d, X.LEDGER_PROBLEMS), levels.ledger_state(table))


@query(f"SELECT *, coalesce((approved + rejected + failed) * 100.0::DOUBLE / nullif(total, 0), 100.0) AS progress_percent, pending = 0 AND generated = 0 AND retrypending = 0 AS is_complete FROM (SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ledger.STATUSES) + f", (SELECT sum(cost) FROM ({X.OPS}) o WHERE type = 'generated' AND problem_id <> 'unknown') AS gen_cost, (SELECT sum(judge_cost) FROM ({X.OPS}) o WHERE type = 'judged' AND problem_id <> 'unknown') AS judge_cost FROM ({_LEDGER}) l) t")
def ledger_stats(spark: SparkSession, d: str) -> DataFrame:
    return ledger.ledger_stats(_ledger(spark, d), X.frame(spark, d, X.OPS))


@query(f"SELECT id FROM ({_LEDGER}) l WHERE status IN ('pending', 'retrypending')")
def pending_problems(spark: SparkSession, d: str) -> DataFrame:
    return ledger.filter_pending(X.frame(spark, d, X.LEDGER_PROBLEMS), _ledger(spark, d)).select("id")


@query(f"SELECT id, 'pending' AS status, CAST(0 AS INT) AS retry_count, 0.0::DOUBLE AS gen_cost FROM ({X.LEDGER_PROBLEMS}) p")
def ledger_init(spark: SparkSession, d: str) -> DataFrame:
    return ledger.init_ledger(X.frame(spark, d, X.LEDGER_PROBLEMS)).select("id", "status", "retry_count", "gen_cost")


@query(f"SELECT id FROM ({_LEDGER}) l WHERE status IN ('pending', 'retrypending', 'generated')")
def pending_with_new(spark: SparkSession, d: str) -> DataFrame:
    """Problems to be done where the ledger misses some, and those that got stuck before judgment."""
    known = _ledger(spark, d).filter("status <> 'pending'")
    return ledger.filter_pending(X.frame(spark, d, X.LEDGER_PROBLEMS), known, include_new=True, stuck_as_pending=True).select("id")


@query(f"SELECT id, retry_count, retry_reason FROM ({_LEDGER}) l WHERE status = 'retrypending'")
def retry_pending(spark: SparkSession, d: str) -> DataFrame:
    return ledger.retry_pending(_ledger(spark, d))


@query(f"SELECT id, CASE WHEN status = 'retrypending' AND retry_count >= 10 THEN 'failed' ELSE status END AS status FROM ({_LEDGER}) l")
def retry_limit(spark: SparkSession, d: str) -> DataFrame:
    return ledger.apply_retry_limit(_ledger(spark, d), 10).select("id", "status")


_AFTER = "CASE WHEN type = 'generated' THEN 'generated' WHEN type = 'failed' THEN 'retrypending' WHEN verdict = 'approve' THEN 'approved' ELSE 'rejected' END"


@query(f"SELECT problem_id, seq, coalesce(lag({_AFTER}) OVER (PARTITION BY problem_id ORDER BY seq), 'pending') AS before, {_AFTER} AS after FROM ({X.OPS}) o")
def ledger_replay(spark: SparkSession, d: str) -> DataFrame:
    return ledger.replay_counters(X.frame(spark, d, X.OPS))


_COUNTED = ("pending", "generated", "approved", "rejected", "retrypending")


@query(f"SELECT seq, problem_id, " + ", ".join(f"CAST({f'(SELECT count(*) FROM ({X.LEDGER_PROBLEMS}) p) + ' if s == 'pending' else ''}sum((after = '{s}')::INT - (before = '{s}')::INT) OVER (ORDER BY seq, problem_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {s}" for s in _COUNTED) + f" FROM (SELECT problem_id, seq, coalesce(lag({_AFTER}) OVER (PARTITION BY problem_id ORDER BY seq), 'pending') AS before, {_AFTER} AS after FROM ({X.OPS}) o WHERE problem_id IN (SELECT id FROM ({X.LEDGER_PROBLEMS}) p)) r")
def ledger_counters(spark: SparkSession, d: str) -> DataFrame:
    return ledger.running_counters(X.frame(spark, d, X.LEDGER_PROBLEMS), X.frame(spark, d, X.OPS), _shared(spark, "counters"))


# --- exports ----------------------------------------------------------------------------------------------------------


@query(f"SELECT input AS prompt, output AS completion FROM ({X.SCORED}) s")
def export_sft(spark: SparkSession, d: str) -> DataFrame:
    return exports.to_sft(_scored(spark, d))


@query(f"SELECT input AS prompt, chosen, rejected FROM ({_PAIRS}) p")
def export_dpo(spark: SparkSession, d: str) -> DataFrame:
    return exports.to_dpo(_pairs(spark, d))


@query(f"SELECT input AS prompt, output AS completion, score AS reward FROM ({X.SCORED}) s")
def export_reward(spark: SparkSession, d: str) -> DataFrame:
    return exports.to_reward(_scored(spark, d))


@query(f"SELECT problem_id, problem_id AS prompt, list(output ORDER BY response_idx) AS completions, list(score ORDER BY response_idx) AS scores FROM ({X.JUDGED}) j GROUP BY problem_id")
def export_grpo(spark: SparkSession, d: str) -> DataFrame:
    return exports.to_grpo(X.frame(spark, d, X.JUDGED).withColumn("input", F.col("problem_id"))).drop("part")


@query(f"SELECT problem_id, part, problem_id AS prompt, list(output ORDER BY response_idx) AS completions, list(score ORDER BY response_idx) AS scores FROM (SELECT *, CAST((row_number() OVER (PARTITION BY problem_id ORDER BY response_idx) - 1) // 3 AS INT) AS part FROM ({X.JUDGED}) j) k GROUP BY problem_id, part")
def export_grpo_parts(spark: SparkSession, d: str) -> DataFrame:
    """Trainer rows of three responses at most."""
    return exports.to_grpo(X.frame(spark, d, X.JUDGED).withColumn("input", F.col("problem_id")), 3)


@query(f"SELECT problem_id, count(*) AS responses FROM ({X.JUDGED}) j GROUP BY problem_id HAVING count(*) > 6")
def export_grpo_oversized(spark: SparkSession, d: str) -> DataFrame:
    """Problems with too many responses for one trainer row of at most six."""
    return exports.oversized(X.frame(spark, d, X.JUDGED), 6)


@query(f"SELECT input AS prompt, output AS completion, score >= {THRESHOLD} AS label FROM ({X.SCORED}) s")
def export_kto(spark: SparkSession, d: str) -> DataFrame:
    return exports.to_kto(_scored(spark, d), THRESHOLD)


@query(f"SELECT input, chosen, rejected FROM ({_PAIRS}) p")
def trainer_files(spark: SparkSession, d: str) -> DataFrame:
    """Preference rows through a trainer's files, with its name for the prompt."""
    path = _shared(spark, "trainer")
    exports.write_trainer(exports.to_dpo(_pairs(spark, d)), path, "dpo", {"prompt": "input"})
    return spark.read.schema("input string, chosen string, rejected string").json(path)


# --- requests ---------------------------------------------------------------------------------------------------------

_MODEL = "CASE WHEN o_orderkey % 3 < 2 THEN 'model-0' ELSE 'model-1' END"


@query(f"SELECT id, {_MODEL} AS model, CASE WHEN o_orderkey % 3 < 2 THEN 'alpha' ELSE 'beta' END AS endpoint, '{{\"model\":\"' || {_MODEL} || '\",\"messages\":[{{\"role\":\"system\",\"content\":\"Be brief.\"}},{{\"role\":\"user\",\"content\":\"Solve the following problem:\\n\\n' || input || '\\n\\nProvide your reasoning and final answer.\"}}],\"max_tokens\":4096,\"temperature\":0.7}}' AS body, sha256('generate' || chr(1) || id || chr(1) || {_MODEL}) AS request_id FROM ({X.PROBLEMS}) p")
def generation_requests(spark: SparkSession, d: str) -> DataFrame:
    return requests.generation_requests(X.frame(spark, d, X.PROBLEMS), GENERATORS, "Be brief.", ordinal="o_orderkey").select("id", "model", "endpoint", "body", "request_id")


#: A user's turn and the assistant's turn right after it.
_TURNS = "SELECT conv_id, turn, text AS input, reply AS output FROM (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS reply, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations) c WHERE role = 'user' AND next_role = 'assistant'"
# The judge's prompt.
_ASKED = "'## Sample to Evaluate' || chr(10) || chr(10) || '**Problem:**' || chr(10) || input || chr(10) || chr(10) || '**Generated Response:**' || chr(10) || output || chr(10) || chr(10) || '**Extracted Answer:**' || chr(10) || '(not extracted)' || chr(10) || chr(10) || 'Please evaluate this sample according to the criteria and provide:' || chr(10) || '1. A score from 0.0 to 1.0' || chr(10) || '2. Your reasoning' || chr(10) || '3. A verdict: APPROVE or REJECT'"


@query(f"SELECT conv_id, turn, CAST(i AS INT) AS judge_ordinal, CASE WHEN i < 2 THEN 'judge-0' ELSE 'judge-1' END AS model, 0.3::DOUBLE AS temperature, 'user' AS role, {_ASKED} AS content FROM ({_TURNS}) t, range(0, 3) AS r(i)")
def judge_requests(spark: SparkSession, d: str) -> DataFrame:
    turns = X.frame(spark, d, _TURNS).withColumn("id", TX.stable_id("conv_id", "turn")).withColumn("answer", F.lit(None).cast("string"))
    asked = requests.judge_requests(turns, JUDGES, 3, "Judge.")
    return asked.select("conv_id", "turn", "judge_ordinal", "model", "temperature", F.get("messages", 1)["role"].alias("role"), F.get("messages", 1)["content"].alias("content"))


#: Orders as requests; their answers are whole, without usage, with half of it, without choices, or missing.
_ANSWERED = """SELECT CAST(o_orderkey AS STRING) AS request_id, o_orderkey, CASE o_orderkey % 6
  WHEN 0 THEN '{"choices":[{"message":{"role":"assistant","content":"' || o_orderpriority || '"}}],"usage":{"prompt_tokens":10,"completion_tokens":20,"total_tokens":30},"model":"other"}'
  WHEN 1 THEN '{"choices":[{"message":{"role":"assistant","content":"' || o_orderpriority || '"}}]}'
  WHEN 2 THEN '{"choices":[{"message":{"role":"assistant","content":"x"}}],"usage":{"prompt_tokens":10}}'
  WHEN 3 THEN '{"choices":[]}'
  WHEN 4 THEN '{"choices":[{"message":{"role":"assistant","content":null}}]}' END AS body FROM orders"""


@query("SELECT CAST(o_orderkey AS VARCHAR) AS request_id, CASE WHEN o_orderkey % 6 < 2 THEN o_orderpriority END AS content, CASE o_orderkey % 6 WHEN 0 THEN 'other' WHEN 1 THEN 'model-0' END AS model, CASE o_orderkey % 6 WHEN 0 THEN CAST(10 AS BIGINT) WHEN 1 THEN CAST(0 AS BIGINT) END AS tokens_in, CASE o_orderkey % 6 WHEN 0 THEN CAST(20 AS BIGINT) WHEN 1 THEN CAST(0 AS BIGINT) END AS tokens_out, CASE o_orderkey % 6 WHEN 0 THEN CAST(30 AS BIGINT) WHEN 1 THEN CAST(0 AS BIGINT) END AS total_tokens, CASE o_orderkey % 6 WHEN 0 THEN round(10 / 1e6::DOUBLE * 0.5::DOUBLE + 20 / 1e6::DOUBLE * 1.5::DOUBLE, 12) WHEN 1 THEN 0.0::DOUBLE END AS cost_usd, CASE o_orderkey % 6 WHEN 2 THEN 'bad_usage' WHEN 3 THEN 'no_content' WHEN 4 THEN 'no_content' WHEN 5 THEN 'no_response' END AS error FROM orders")
def ingest_responses(spark: SparkSession, d: str) -> DataFrame:
    answers = X.frame(spark, d, _ANSWERED)
    asked = answers.select("request_id", F.lit("").alias("body"), F.lit("model-0").alias("model"))
    ok, failed = requests.ingest_responses(asked, answers.filter("body IS NOT NULL"), GENERATORS)
    return ok.select("request_id", "content", "model", "tokens_in", "tokens_out", "total_tokens", F.round("cost_usd", 12).alias("cost_usd"), F.lit(None).cast("string").alias("error")).unionByName(failed, allowMissingColumns=True)


@query(f"SELECT endpoint, count(*) AS requests, count(*) FILTER (WHERE status = 429) AS rate_limited, count(*) FILTER (WHERE status = 429) / count(*)::DOUBLE AS rate_limited_share, sum(wait_ms) / 1000.0::DOUBLE AS wait_secs, count(DISTINCT model) AS models FROM ({X.REQUEST_LOG}) l GROUP BY endpoint")
def rate_limit_stats(spark: SparkSession, d: str) -> DataFrame:
    return ratelimit.rate_limit_stats(X.frame(spark, d, X.REQUEST_LOG))


@query(f"SELECT event_id, model, consecutive_429, CASE WHEN status = 429 THEN least(pow(2.0::DOUBLE, consecutive_429), 60.0::DOUBLE) END AS backoff_secs FROM (SELECT *, count(*) FILTER (WHERE status = 429) OVER (PARTITION BY model, g ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING) AS consecutive_429 FROM (SELECT *, count(*) FILTER (WHERE status < 400) OVER (PARTITION BY model ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING) AS g FROM ({X.REQUEST_LOG}) l) a) b")
def backoff_timeline(spark: SparkSession, d: str) -> DataFrame:
    return ratelimit.backoff_timeline(X.frame(spark, d, X.REQUEST_LOG), chunk="6 hours").select("event_id", "model", "consecutive_429", "backoff_secs")


@query(f"""WITH a AS (SELECT * FROM ({X.ATTEMPTS}) x WHERE attempt < 3),
e AS (SELECT request_id, min(attempt) FILTER (WHERE status BETWEEN 200 AND 299 OR status IN (401, 404)) AS ended, max(attempt) AS tried FROM a GROUP BY request_id)
SELECT a.request_id, CASE WHEN e.ended IS NULL THEN 'exhausted' WHEN a.status NOT BETWEEN 200 AND 299 THEN 'refused' WHEN a.body = 'oops' THEN 'parse_error' ELSE 'success' END AS outcome, a.status, a.error, CAST(a.attempt + 1 AS INT) AS attempts_used
FROM a JOIN e ON e.request_id = a.request_id AND a.attempt = coalesce(e.ended, e.tried)""")
def resolve_attempts(spark: SparkSession, d: str) -> DataFrame:
    return requests.resolve_attempts(X.frame(spark, d, X.ATTEMPTS))


# --- sources, sinks, streams ------------------------------------------------------------------------------------------


@query(f"SELECT id, input, '{{\"n\":' || CAST(o_orderkey AS VARCHAR) || '}}' AS metadata FROM ({X.PROBLEMS}) p")
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = _shared(spark, "jsonl")
    jsonl.write_jsonl(X.frame(spark, d, X.PROBLEMS).select("id", "input", F.concat(F.lit('{"n":'), F.col("o_orderkey").cast("string"), F.lit("}")).alias("metadata")), path)
    return jsonl.load_problems(spark, path)


_BAD = "CASE o_orderkey % 7 WHEN 1 THEN 'malformed' WHEN 2 THEN 'no id' WHEN 3 THEN 'no input' END"


@query(f"SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS BIGINT) AS line, {_BAD} AS reason FROM orders QUALIFY {_BAD} IS NOT NULL")
def malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of three files, of which some are broken, blank, or miss a field, with their place in their file."""
    key, path = F.col("o_orderkey"), _shared(spark, "lines")
    whole = F.to_json(F.struct(key.cast("string").alias("id"), F.col("o_orderpriority").alias("input")))
    text = F.when(key % 7 == 0, F.lit("  ")).when(key % 7 == 1, F.concat(F.lit('{"id": "'), key.cast("string"), F.lit('", "input'))).when(key % 7 == 2, F.to_json(F.struct(F.lit("x").alias("input"), key.cast("string").alias("key")))).when(key % 7 == 3, F.to_json(F.struct(key.cast("string").alias("id")))).otherwise(whole)
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus", text.alias("value"))
    orders.repartition(3, "o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey").select("o_orderstatus", "value").write.partitionBy("o_orderstatus").text(path)
    bad = jsonl.malformed_lines(spark, path)
    return bad.select(F.regexp_extract("text", '"(?:id|key)": ?"([0-9]+)"', 1).cast("bigint").alias("o_orderkey"), "line", "reason")


@query(_SFT)
def sft_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Fine-tuning rows through JSON lines."""
    path = _shared(spark, "sft")
    jsonl.write_jsonl(_sft(spark, d), path)
    return _flat(jsonl.read_sft(spark, path))


@query(_PAIRS)
def dpo_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Preference pairs through JSON lines."""
    path = _shared(spark, "dpo")
    jsonl.write_jsonl(_pairs(spark, d), path)
    return jsonl.read_dpo(spark, path)


@query(f"SELECT id, input, CAST(o_orderkey % 3 AS BIGINT) AS batch_id FROM ({X.PROBLEMS}) p WHERE o_orderkey % 3 < 2")
def commit_batch_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """Three batches: one written twice, one that broke off before its operations were written."""
    out, log = _shared(spark, "rows"), _shared(spark, "ops")
    rows = X.frame(spark, d, X.PROBLEMS)
    for batch in (0, 1, 1):
        mine = rows.filter(F.col("o_orderkey") % 3 == batch)
        ops = mine.select(F.col("o_orderkey").alias("seq"), F.lit("judged").alias("type"), F.col("id").alias("problem_id"), *[F.lit(None).cast(t).alias(c) for c, t in (("model", "string"), ("cost", "double"), ("score", "double"), ("verdict", "string"), ("judge_cost", "double"), ("output_json", "string"), ("reason", "string"), ("at", "timestamp"))])
        commit.commit_batch(mine.select("id", "input"), ops, out, log, batch)
    commit.stage(rows.filter(F.col("o_orderkey") % 3 == 2).select("id", "input"), out, 2, commit.new_try())
    return commit.committed(spark, out, log).select("id", "input", "batch_id")


@query(f"SELECT id, input, CAST(o_orderkey % 3 AS BIGINT) AS batch_id FROM ({X.PROBLEMS}) p WHERE o_orderkey % 3 = 0 OR (o_orderkey % 3 = 2 AND o_orderkey % 2 = 0)")
def retry_without_rows(spark: SparkSession, d: str) -> DataFrame:
    """A batch committed once, one whose first try broke off and whose second has no rows, and one committed again with
    half of its rows; what the tries that do not count left behind is removed."""
    out, log = _shared(spark, "rows"), _shared(spark, "ops")
    rows = X.frame(spark, d, X.PROBLEMS)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("model", "string"), ("cost", "double"), ("score", "double"), ("verdict", "string"), ("judge_cost", "double"), ("output_json", "string"), ("reason", "string"), ("at", "timestamp"))]
    ops = lambda df: df.select(F.col("o_orderkey").alias("seq"), F.lit("judged").alias("type"), F.col("id").alias("problem_id"), *none)
    put = lambda df, batch: commit.commit_batch(df.select("id", "input"), ops(df), out, log, batch)
    of = lambda batch: rows.filter(F.col("o_orderkey") % 3 == batch)
    put(of(0), 0)
    commit.stage(of(1).select("id", "input"), out, 1, commit.new_try())
    put(of(1).limit(0), 1)
    put(of(2), 2)
    put(of(2).filter("o_orderkey % 2 = 0"), 2)
    commit.recover(spark, [out, log], commit.manifest_of(log))
    return commit.committed(spark, out, log).select("id", "input", "batch_id")


def _as_stream(df: DataFrame, spark: SparkSession, name: str, batches: int = 3) -> DataFrame:
    """df written as it is partitioned and read back as a stream of so many batches, each of an equal share of the files."""
    path = _shared(spark, name)
    df.write.parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    if files < batches:  # too small a table for several batches
        whole, path = spark.read.schema(df.schema).parquet(path), _shared(spark, name)
        whole.repartition(batches).write.parquet(path)
        files = batches
    return spark.readStream.schema(T.StructType.fromJson(df.schema.jsonValue())).option("maxFilesPerTrigger", -(-files // batches)).parquet(path)


@query(f"SELECT problem_id, max(score) AS chosen_score, min(score) AS rejected_score, arg_max(response_idx, (score, -response_idx)) AS chosen_idx, arg_min(response_idx, (score, -response_idx)) AS rejected_idx, count(*) AS responses FROM ({X.JUDGED}) j GROUP BY problem_id HAVING count(*) >= 2 AND max(score) - min(score) >= 0.1::DOUBLE")
def stream_pairs(spark: SparkSession, d: str) -> DataFrame:
    stream = _as_stream(X.frame(spark, d, X.JUDGED).select("problem_id", "sample_id", "response_idx", "score", "model"), spark, "judged")
    out = _shared(spark, "pairs")
    streams.upsert(streams.pair_updates(stream), out, "problem_id", _shared(spark, "state")).awaitTermination()
    new = streams.latest(spark, out, "problem_id")
    rows = new.select("problem_id", F.col("chosen.score").alias("chosen_score"), F.col("rejected.score").alias("rejected_score"), F.col("chosen.response_idx").alias("chosen_idx"), F.col("rejected.response_idx").alias("rejected_idx"), "responses")
    return rows.filter((F.col("responses") >= 2) & (F.col("chosen_score") - F.col("rejected_score") >= dpo.MIN_GAP))


@query(f"SELECT id, status, retry_count FROM ({_LEDGER}) l WHERE id <> 'untouched'")
def stream_ledger(spark: SparkSession, d: str) -> DataFrame:
    stream = _as_stream(X.frame(spark, d, X.OPS).filter("problem_id <> 'unknown'"), spark, "ops")
    out = _shared(spark, "ledger")
    streams.upsert(streams.ledger_updates(stream), out, "id", _shared(spark, "state"), fan=2).awaitTermination()
    return streams.latest(spark, out, "id").select("id", "status", "retry_count")


@query(f"SELECT doc_id, {_ANSWER} AS answer, {_FLAGS} FROM ({X.OUTPUTS}) o")
def stream_flags(spark: SparkSession, d: str) -> DataFrame:
    """Answers and quality flags of a stream of outputs."""
    stream, out = _as_stream(X.frame(spark, d, X.OUTPUTS).select("doc_id", "output"), spark, "outputs"), _shared(spark, "flags")
    streams.stream_rows(stream).drop("output").writeStream.option("checkpointLocation", _shared(spark, "state")).trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    return spark.read.parquet(out).select("doc_id", "answer", "quality_flags.*")


@query(f"SELECT id, score, verdict FROM ({X.SCORED}) s WHERE verdict = 'approve'")
def stream_sft(spark: SparkSession, d: str) -> DataFrame:
    stream = _as_stream(_scored(spark, d).select("id", "problem_id", "score", "verdict", "judge_cost_usd"), spark, "scored")
    out, log = _shared(spark, "rows"), _shared(spark, "ops")
    streams.stream_sft(stream, out, log, _shared(spark, "state")).awaitTermination()
    return commit.committed(spark, out, log).select("id", "score", "verdict")


@query(f"SELECT CAST(user_id AS VARCHAR) AS problem_id, date_trunc('day', ts) AS day, max(event_id % 100) / 100.0::DOUBLE AS chosen_score, min(event_id % 100) / 100.0::DOUBLE AS rejected_score, arg_max(event_id, (event_id % 100, -event_id)) AS chosen_idx, arg_min(event_id, (event_id % 100, -event_id)) AS rejected_idx, count(*) AS responses FROM events WHERE ts < (SELECT date_trunc('day', max(ts)) FROM events) GROUP BY 1, 2")
def stream_final_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Best and worst response per user and day, in append mode: days that the watermark has passed."""
    events = spark.read.parquet(f"{d}/events.parquet")
    judged = events.select(F.col("user_id").cast("string").alias("problem_id"), F.col("event_id").cast("string").alias("sample_id"), F.col("event_id").alias("response_idx"), (F.col("event_id") % 100 / 100).alias("score"), F.col("event_type").alias("model"), F.col("ts").cast("timestamp").alias("ts"))
    path, out = _shared(spark, "judged"), _shared(spark, "final")
    judged.write.parquet(path)
    stream = spark.readStream.schema(judged.schema).parquet(path)
    streams.final_pairs(stream, "ts", "0 seconds", "1 day").writeStream.outputMode("append").option("checkpointLocation", _shared(spark, "state")).trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    return spark.read.parquet(out).select("problem_id", F.col("window.start").cast("timestamp_ntz").alias("day"), F.col("chosen.score").alias("chosen_score"), F.col("rejected.score").alias("rejected_score"), F.col("chosen.response_idx").alias("chosen_idx"), F.col("rejected.response_idx").alias("rejected_idx"), "responses")


def _user_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream of judged responses, a problem per user."""
    events = spark.read.parquet(f"{d}/events.parquet")
    judged = events.select(F.col("user_id").cast("string").alias("problem_id"), F.col("event_id").cast("string").alias("sample_id"), F.col("event_id").alias("response_idx"), (F.col("event_id") % 100 / 100).alias("score"), F.col("event_type").alias("model"), F.col("ts").cast("timestamp").alias("ts"))
    path = _shared(spark, "judged")
    judged.write.parquet(path)
    return spark.readStream.schema(judged.schema).parquet(path)


def _sessions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    folder = _shared(spark, "sessions")
    streams.stream_session_pairs(_user_stream(spark, d), "ts", "0 seconds", "10 hours", folder, _shared(spark, "state")).awaitTermination()
    return streams.read_sessions(spark, folder, "bigint")


_GAP = "INTERVAL 10 HOURS"
_SESSIONS = f"""SELECT CAST(user_id AS VARCHAR) AS problem_id, min(ts) AS started, max(ts) + {_GAP} AS ended, max(event_id % 100) / 100.0::DOUBLE AS chosen_score, min(event_id % 100) / 100.0::DOUBLE AS rejected_score,
  arg_max(event_id, (event_id % 100, -event_id)) AS chosen_idx, arg_min(event_id, (event_id % 100, -event_id)) AS rejected_idx, count(*) AS responses
FROM (SELECT *, count(*) FILTER (WHERE before IS NULL OR ts - before > {_GAP}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) e) f
GROUP BY user_id, s HAVING max(ts) + {_GAP} <= (SELECT max(ts) FROM events)"""


@query(f"SELECT problem_id, started, ended, chosen_score, rejected_score, chosen_idx, rejected_idx, responses FROM ({_SESSIONS}) s WHERE responses >= 2 AND chosen_score - rejected_score >= 0.1::DOUBLE")
def stream_session_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of the sessions of each user's responses that the watermark has closed."""
    pairs, _ = _sessions(spark, d)
    at = lambda c: F.col(f"session.{c}").cast("timestamp_ntz")
    return pairs.select("problem_id", at("start").alias("started"), at("end").alias("ended"), F.col("chosen.score").alias("chosen_score"), F.col("rejected.score").alias("rejected_score"), F.col("chosen.response_idx").alias("chosen_idx"), F.col("rejected.response_idx").alias("rejected_idx"), "responses")


@query(f"SELECT problem_id, started, responses, 'insufficient_samples' AS reason FROM ({_SESSIONS}) s WHERE responses < 2")
def stream_insufficient(spark: SparkSession, d: str) -> DataFrame:
    """Sessions closed with fewer than two responses, from the same stream as the pairs."""
    _, few = _sessions(spark, d)
    return few.select("problem_id", F.col("session.start").cast("timestamp_ntz").alias("started"), "responses", "reason")


# --- workloads --------------------------------------------------------------------------------------------------------


def _reply(content: str) -> str:
    return json.dumps({"choices": [{"message": {"role": "assistant", "content": content}}], "usage": {"prompt_tokens": 10, "completion_tokens": 20, "total_tokens": 30}})


def _asked_for(body: str) -> tuple[str, str]:
    """(model, last message) of a request."""
    got = json.loads(body)
    return got["model"], got["messages"][-1]["content"]


def _solve(step: str):
    """Repeats the order's priority as answer; open orders in part (status P) time out."""

    def reply(body: str) -> tuple[str | None, str | None]:
        priority, status = _asked_for(body)[1].split("\n\n")[1].rsplit(" ", 1)
        return (None, "timeout") if status == "P" else (_reply(f"{step} <answer>{priority}</answer>"), None)

    return workloads.replay(reply)


def _review(body: str) -> tuple[str | None, str | None]:
    return _reply("Score: 0.9 APPROVE" if any(x in _asked_for(body)[1] for x in ("<answer>1-", "<answer>2-")) else "Score: 0.2 REJECT"), None


_SOLVED = "SELECT sha256(id) AS id, id AS problem_id, input, {} || ' <answer>' || p || '</answer>' AS output, p AS answer, 'model-0' AS model, 0.9::DOUBLE AS score, 'approve' AS verdict FROM (SELECT 'ord_' || CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority || ' ' || o_orderstatus AS input, o_orderpriority AS p, o_orderstatus AS s, o_orderkey FROM orders) o WHERE s <> 'P' AND p[1] IN ('1', '2')"
_ROW = ("id", "problem_id", "input", "output", "answer", "model", "score", "verdict")
_PROMPTS = ("Be brief.", "Judge.")
#: Requests of a task: recorded answers cost nothing, so many are asked before they are kept.
_EVERY = 2048


@query(_SOLVED.format("'Step 1'"))
def replay_sft(spark: SparkSession, d: str) -> DataFrame:
    """Problems to fine-tuning rows in two batches, with a recorded model."""
    problems = X.frame(spark, d, X.PROBLEMS).select("id", "input", "metadata")
    return workloads.run_sft(problems, GENERATORS[:1], JUDGES[:1], _PROMPTS, _solve("Step 1"), workloads.replay(_review), _shared(spark, "sft"), batches=2, every=_EVERY).select(*_ROW)


@query(f"SELECT id AS problem_id, 'generation' AS stage, 'timeout' AS error FROM ({X.PROBLEMS}) p WHERE input LIKE '% P'")
def replay_failures(spark: SparkSession, d: str) -> DataFrame:
    problems, folder = X.frame(spark, d, X.PROBLEMS).select("id", "input", "metadata"), _shared(spark, "sft")
    workloads.run_sft(problems, GENERATORS[:1], JUDGES[:1], _PROMPTS, _solve("Step 1"), workloads.replay(_review), folder, every=_EVERY)
    return workloads.failures(spark, folder).select("problem_id", "stage", "error")


@query(_SOLVED.format("CASE WHEN o_orderkey % 2 = 0 THEN 'Step 1' ELSE 'Step 2' END"))
def resume_after_crash(spark: SparkSession, d: str) -> DataFrame:
    """A run over half the problems, a try that broke off before its operations, and a run over all with a model that
    answers otherwise: what was done stays as it was."""
    problems, folder = X.frame(spark, d, X.PROBLEMS).select("id", "input", "metadata", "o_orderkey"), _shared(spark, "sft")
    run = lambda some, step: workloads.run_sft(some.select("id", "input", "metadata"), GENERATORS[:1], JUDGES[:1], _PROMPTS, _solve(step), workloads.replay(_review), folder, every=_EVERY)
    first = run(problems.filter("o_orderkey % 2 = 0"), "Step 1")
    commit.stage(first.limit(10), f"{folder}/rows", 1, commit.new_try())
    return run(problems, "Step 2").select(*_ROW)


@query(_SOLVED.format("'Step 1'"))
def resume_repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    """Every problem stands three times, twice as it was before; a run over a part of the last ones, and one over all."""
    now = X.frame(spark, d, X.PROBLEMS).select("id", "input", "metadata", F.lit(2).alias("n"), "o_orderkey")
    old = now.withColumn("input", F.concat(F.lit("5-LOW "), F.lit("P")))
    every, folder = old.withColumn("n", F.lit(0)).unionByName(now).unionByName(old.withColumn("n", F.lit(1))), _shared(spark, "sft")
    run = lambda some: workloads.run_sft(some.drop("o_orderkey"), GENERATORS[:1], JUDGES[:1], _PROMPTS, _solve("Step 1"), workloads.replay(_review), folder, batches=2, every=_EVERY, order="n")
    run(every.filter("o_orderkey % 5 = 0"))
    return run(every).select(*_ROW)


def _respond(body: str) -> tuple[str | None, str | None]:
    """model-1 answers better; model-0 fails on open orders in part."""
    model, content = _asked_for(body)
    priority, status = content.split("\n\n")[1].rsplit(" ", 1)
    if model == "model-0" and status == "P":
        return None, "timeout"
    return _reply(f"{'better' if model == 'model-1' else 'plain'} {priority}"), None


def _compare(body: str) -> tuple[str | None, str | None]:
    content = _asked_for(body)[1]
    return _reply("Score: 0.5 APPROVE" if "plain" in content else "Score: 0.55 APPROVE" if "better 5-LOW" in content else "Score: 0.9 APPROVE"), None


@query("SELECT sha256(id) AS id, id AS problem_id, input, 'better ' || p AS chosen, 'plain ' || p AS rejected, 0.9::DOUBLE AS chosen_score, 0.5::DOUBLE AS rejected_score, 'model-1' AS chosen_model, 'model-0' AS rejected_model FROM (SELECT 'ord_' || CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority || ' ' || o_orderstatus AS input, o_orderpriority AS p, o_orderstatus AS s FROM orders) o WHERE s <> 'P' AND p <> '5-LOW'")
def replay_dpo(spark: SparkSession, d: str) -> DataFrame:
    """Problems to preference pairs of three responses each, with recorded models."""
    problems = X.frame(spark, d, X.PROBLEMS).select("id", "input", "metadata")
    return workloads.run_dpo(problems, GENERATORS, JUDGES[:1], _PROMPTS, workloads.replay(_respond), workloads.replay(_compare), _shared(spark, "dpo"), every=_EVERY).drop("metadata")
