"""Input tables of the registered queries, derived from the driver's tables by the same SQL in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

NL = "chr(10)"

PROBLEMS = "SELECT 'ord_' || CAST(o_orderkey AS STRING) AS id, o_orderpriority || ' ' || o_orderstatus AS input, CAST(NULL AS STRING) AS metadata, o_orderkey FROM orders"

JUDGED = """SELECT problem_id || '_' || CAST(response_idx AS STRING) AS sample_id, * FROM (
  SELECT 'ord_' || CAST(l_orderkey AS STRING) AS problem_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INT) AS response_idx,
    l_discount * 10 AS score, 'model-' || CAST(l_suppkey % 2 AS STRING) AS model, CASE WHEN l_suppkey % 2 = 0 THEN 'alpha' ELSE 'beta' END AS endpoint,
    CAST(l_quantity AS BIGINT) AS tokens_in, l_partkey AS tokens_out,
    CASE WHEN l_returnflag = 'R' THEN 'reject' ELSE 'approve' END AS verdict,
    l_tax AS judge_cost_usd, 'line ' || CAST(l_partkey AS STRING) || ' ' || l_returnflag AS output
  FROM lineitem) x"""

JUDGE_RESULTS = """SELECT CAST(l_orderkey AS STRING) AS sample_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INT) AS judge_ordinal,
  l_discount * 10 AS score,
  CASE l_returnflag WHEN 'A' THEN 'approve' WHEN 'R' THEN 'reject' ELSE CASE WHEN l_discount * 10 >= 0.85 THEN 'approve' ELSE 'reject' END END AS verdict,
  'reason ' || CAST(l_partkey AS STRING) AS reasoning, 'judge-' || CAST(l_suppkey % 4 AS STRING) AS judge_model,
  CAST(l_quantity AS BIGINT) AS judge_time_ms, l_tax AS judge_cost_usd
FROM lineitem"""

OUTPUTS = f"""SELECT doc_id, text, lang, source, n_chars, CASE doc_id % 12
  WHEN 0 THEN text
  WHEN 1 THEN 'Step 1 ' || text || ' <answer> ' || CAST(n_chars AS STRING) || ' </answer>'
  WHEN 2 THEN text || '<answer>a' || {NL} || 'b</answer>'
  WHEN 3 THEN text || '<answer></answer>'
  WHEN 4 THEN text || {NL} || '## Answer' || {NL} || CAST(n_chars AS STRING)
  WHEN 5 THEN text || {NL} || '## Answer' || {NL} || CAST(n_chars AS STRING) || {NL}
  WHEN 6 THEN text || {NL} || '## Answer' || {NL} || CAST(n_chars AS STRING) || {NL} || '## Next'
  WHEN 7 THEN text || {NL} || {NL} || 'last'
  WHEN 8 THEN text || '...'
  WHEN 9 THEN text || ':'
  WHEN 10 THEN 'Wait, ' || text
  ELSE '' END AS output FROM documents"""

REPLIES = """SELECT doc_id, CASE doc_id % 10
  WHEN 0 THEN 'Score: 0.' || CAST(doc_id % 97 AS STRING)
  WHEN 1 THEN '**Score**: 0.' || CAST(doc_id % 89 AS STRING) || ' APPROVE'
  WHEN 2 THEN '**Score:** 0.' || CAST(doc_id % 83 AS STRING)
  WHEN 3 THEN 'Overall score: 0.' || CAST(doc_id % 79 AS STRING) || ' REJECT'
  WHEN 4 THEN '{"scores": {"completeness": 0.' || CAST(doc_id % 9 AS STRING) || ', "accuracy": 0.9, "reasoning_validity": 0.8, "answer_correctness": 0.' || CAST(doc_id % 7 + 3 AS STRING) || ', "clarity": 0.9}, "overall_score": 0.' || CAST(doc_id % 5 + 5 AS STRING) || ', "verdict": "needs_revision"}'
  WHEN 5 THEN 'Score: 85'
  WHEN 6 THEN 'no number here'
  WHEN 7 THEN 'NOT APPROVE, score 0.' || CAST(doc_id % 73 AS STRING)
  WHEN 8 THEN 'DISAPPROVE'
  ELSE 'needs_revision, rated 0.' || CAST(doc_id % 71 AS STRING) END AS reply FROM documents"""

SCORED = f"""SELECT CAST(o.doc_id AS STRING) AS id, o.source AS problem_id, o.lang || ' ' || o.source AS input, o.output, 'model-' || CAST(o.doc_id % 3 AS STRING) AS model,
  o.n_chars AS tokens_in, o.n_chars % 100 AS tokens_out, CAST(o.doc_id % 11 AS DOUBLE) / 8 AS cost_usd, CAST(o.doc_id % 3 AS DOUBLE) / 16 AS judge_cost_usd,
  0.5 + l.quality * 0.4 - l.toxic * 0.25 + CAST(o.doc_id % 2 AS DOUBLE) / 16 AS score,
  CASE WHEN l.toxic = 1 THEN 'reject' ELSE 'approve' END AS verdict, CAST(1 + o.doc_id % 3 AS INT) AS num_judges
FROM ({OUTPUTS}) o JOIN labels l ON o.doc_id = l.doc_id"""

OPS = """SELECT event_id AS seq, CAST(0 AS BIGINT) AS batch_id,
  CASE event_type WHEN 'click' THEN 'generated' WHEN 'view' THEN 'judged' WHEN 'purchase' THEN 'judged' WHEN 'error' THEN 'failed' ELSE 'generated' END AS type,
  CASE WHEN event_type = 'signup' THEN 'unknown' ELSE CAST(user_id AS STRING) END AS problem_id,
  CASE WHEN event_type = 'click' THEN 'model-' || CAST(event_id % 3 AS STRING) END AS model,
  CASE WHEN event_type IN ('click', 'signup') THEN CAST(event_id % 8 AS DOUBLE) / 8 END AS cost,
  CASE WHEN event_type IN ('view', 'purchase') THEN CAST(event_id % 100 AS DOUBLE) / 100 END AS score,
  CASE event_type WHEN 'view' THEN 'approve' WHEN 'purchase' THEN 'reject' END AS verdict,
  CASE WHEN event_type IN ('view', 'purchase') THEN CAST(event_id % 4 AS DOUBLE) / 4 END AS judge_cost,
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'generation_failed' ELSE 'judgment_failed' END END AS reason, ts AS at
FROM events"""

LEDGER_PROBLEMS = "SELECT DISTINCT CAST(user_id AS STRING) AS id FROM events UNION SELECT 'untouched' AS id"

REQUEST_LOG = """SELECT CAST(event_id AS STRING) AS request_id, event_id, 'alpha' AS endpoint, 'model-' || CAST(user_id % 7 AS STRING) AS model, ts,
  CASE event_type WHEN 'error' THEN 429 WHEN 'purchase' THEN 500 ELSE 200 END AS status, event_id % 50 AS wait_ms FROM events"""

ATTEMPTS = """SELECT CAST(l_orderkey AS STRING) AS request_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INT) AS attempt,
  CASE CAST(l_quantity AS BIGINT) % 6 WHEN 0 THEN 200 WHEN 1 THEN 429 WHEN 2 THEN 500 WHEN 3 THEN 401 WHEN 4 THEN NULL ELSE 503 END AS status,
  CASE CAST(l_quantity AS BIGINT) % 6 WHEN 4 THEN 'timeout' END AS error,
  CASE WHEN CAST(l_quantity AS BIGINT) % 6 = 0 THEN CASE WHEN l_partkey % 5 = 0 THEN 'oops' ELSE '{"choices":[{"message":{"role":"assistant","content":"x"}}]}' END END AS body
FROM lineitem"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The fixture over the tables of sf_dir; only the tables it names are read."""
    used = [t for t in TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)]
    for t in used:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(_braces(sql, used), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def _braces(sql: str, used: list[str]) -> str:
    """Doubles the braces that belong to the SQL's own texts."""
    out = sql.replace("{", "{{").replace("}", "}}")
    for t in used:
        out = out.replace("{{" + t + "}}", "{" + t + "}")
    return out
