"""Schemas of the tables that the operators read and write."""

from __future__ import annotations

PROBLEMS = "id string, input string, metadata string"
SAMPLES = (
    "id string, problem_id string, response_idx int, input string, output string, answer string, model string, generated_at timestamp, "
    "generation_time_ms bigint, tokens_in bigint, tokens_out bigint, cost_usd double, metadata string"
)
JUDGE_RESULTS = (
    "sample_id string, judge_ordinal int, score double, verdict string, reasoning string, judge_model string, judged_at timestamp, "
    "judge_time_ms bigint, judge_cost_usd double"
)
QUALITY_FLAGS = "struct<truncated:boolean,has_answer_tags:boolean,has_reasoning:boolean,self_correction:boolean,reasoning_length:bigint>"
SFT_SAMPLES = (
    "id string, input string, output string, answer string, model string, score double, problem_id string, tokens_in bigint, tokens_out bigint, "
    "judge_reasoning string, generation_time_ms bigint, judge_model string, verdict string, quality_flags " + QUALITY_FLAGS + ", judge_confidence string, "
    "score_std_dev double, num_judges int, individual_scores array<double>, cost_usd double, metadata string"
)
DPO_PAIRS = (
    "id string, problem_id string, input string, chosen string, rejected string, chosen_score double, rejected_score double, "
    "chosen_model string, rejected_model string, metadata string"
)
MODELS = (
    "ordinal int, endpoint string, id string, label string, weight int, input_price_per_1m double, output_price_per_1m double, "
    "max_tokens int, temperature double"
)
OPS = (
    "seq bigint, batch_id bigint, type string, problem_id string, model string, cost double, score double, verdict string, judge_cost double, "
    "output_json string, reason string, at timestamp"
)
CHAT_RESPONSE = (
    "struct<choices:array<struct<message:struct<role:string,content:string>>>,"
    "usage:struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint>,model:string>"
)
RUBRIC = (
    "struct<scores:struct<completeness:double,accuracy:double,reasoning_validity:double,answer_correctness:double,clarity:double>,"
    "overall_score:double,verdict:string,reasoning:string,issues:array<string>,suggestions:array<string>>"
)
