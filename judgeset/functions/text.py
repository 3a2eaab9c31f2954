"""Column functions over the text of responses and judge replies.

Patterns are anchored with \\z and use [^\\n] for a character of a line, because Java's $ and . treat line ends otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from judgeset import schemas

# The markers and patterns that the results are defined by.
TERMINAL = [".", "!", "?", ")", "]", "}", '"', "'", ">", "*"]
ANSWER_TAGS = ["<answer>", "</answer>", "## Answer", "**Answer**", "\\boxed{"]
REASONING = ["## OBSERVE", "### OBSERVE", "K_i", "B_i", "<reasoning>", "Step 1", "First,", "Let's think", "Let me"]
SELF_CORRECTION = ["Wait", "Actually", "Let me reconsider", "I made a mistake", "Correction:", "On second thought"]
SCORE_PATTERNS = [
    r"(?U)[Ss]core[:\s]+(\d+\.?\d*)",
    r"(?U)\*\*[Ss]core\*\*[:\s]+(\d+\.?\d*)",
    r"(?U)[Oo]verall\s+[Ss]core[:\s]+(\d+\.?\d*)",
]
BARE_SCORE = r"(0\.\d+|1\.0)"
DEFAULT_SCORE = 0.5
ANSWER_LIMIT = 500


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_unicode(c: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+\z", "")


def contains_any(c: Column | str, markers: list[str]) -> Column:
    return reduce(Column.__or__, [_col(c).contains(m) for m in markers])


def extract_answer(c: Column | str, dotall: bool = False) -> Column:
    """The answer inside a response: an <answer> tag, else a one-line Answer section, else the last paragraph.

    Tags match within one line unless dotall. Null if there is no text at all; an empty tag gives an empty answer.
    """
    c = _col(c)
    tag = r"(?s)<answer>(.*?)</answer>" if dotall else r"<answer>([^\n]*?)</answer>"
    section = r"(?U)##\s*Answer\s*\n([^\n]*?)(?:\n##|\z)"
    paragraphs = F.filter(F.split(c, "\n\n"), lambda p: trim_unicode(p) != "")
    last = F.substring(trim_unicode(F.try_element_at(paragraphs, F.lit(-1))), 1, ANSWER_LIMIT)
    return F.when(c.rlike(tag), trim_unicode(F.regexp_extract(c, tag, 1))).when(c.rlike(section), trim_unicode(F.regexp_extract(c, section, 1))).otherwise(last)


def is_truncated(c: Column | str) -> Column:
    t = trim_unicode(c)
    return (t != "") & (~F.right(t, F.lit(1)).isin(TERMINAL) | F.endswith(t, F.lit("...")))


def reasoning_length(c: Column | str) -> Column:
    """Bytes before the first <answer>, else before the first Answer heading, else of the whole text."""
    c = _col(c)
    at = lambda tag: F.locate(tag, c)
    before = lambda tag: F.octet_length(F.substring(c, F.lit(1), at(tag) - 1))
    return F.when(at("<answer>") > 0, before("<answer>")).when(at("## Answer") > 0, before("## Answer")).otherwise(F.octet_length(c)).cast("bigint")


def quality_flags(c: Column | str) -> Column:
    return F.struct(
        is_truncated(c).alias("truncated"),
        contains_any(c, ANSWER_TAGS).alias("has_answer_tags"),
        contains_any(c, REASONING).alias("has_reasoning"),
        contains_any(c, SELF_CORRECTION).alias("self_correction"),
        reasoning_length(c).alias("reasoning_length"),
    )


def parse_score(c: Column | str) -> Column:
    """A judge's score: the first pattern that matches, limited to 0..1; else the first bare decimal; else null."""
    c = _col(c)
    number = lambda p: F.regexp_extract(c, p, 1).try_cast("double")
    limited = [F.least(F.lit(1.0), F.greatest(F.lit(0.0), number(p))) for p in SCORE_PATTERNS]
    return F.coalesce(*[F.when(c.rlike(p), x) for p, x in zip(SCORE_PATTERNS, limited, strict=True)], F.when(c.rlike(BARE_SCORE), number(BARE_SCORE)))


def score_or_default(c: Column | str) -> Column:
    return F.coalesce(parse_score(c), F.lit(DEFAULT_SCORE))


def parse_verdict(c: Column | str, score: Column | str, threshold: float) -> Column:
    up = F.upper(_col(c))
    return (
        F.when(up.contains("APPROVE") & ~up.contains("NOT APPROVE"), "approve")
        .when(up.contains("REJECT"), "reject")
        .when(_col(score) >= threshold, "approve")
        .otherwise("reject")
    )


def parse_rubric(c: Column | str) -> Column:
    """The rubric object in a judge's reply, inside a fenced block or bare; null if there is none."""
    c = _col(c)
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    bare = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    body = F.when(fenced != "", fenced).when(bare != "", bare)
    return F.from_json(body, schemas.RUBRIC)


def rubric_verdict(rubric: Column) -> Column:
    """approve, needs_revision or reject by the rubric's own limits; null without a complete rubric."""
    names = ["completeness", "accuracy", "reasoning_validity", "answer_correctness", "clarity"]
    scores = [rubric["scores"][n] for n in names]
    known = reduce(Column.__and__, [s.isNotNull() for s in scores]) & rubric["overall_score"].isNotNull()
    low = F.least(*scores)
    return F.when(known, F.when((rubric["overall_score"] >= 0.85) & (low >= 0.7), "approve").when((rubric["overall_score"] >= 0.6) & (rubric["scores"]["answer_correctness"] >= 0.8), "needs_revision").otherwise("reject"))


# The texts of the two prompts.


def generation_prompt(problem: Column | str) -> Column:
    return F.concat(F.lit("Solve the following problem:\n\n"), _col(problem), F.lit("\n\nProvide your reasoning and final answer."))


def judge_prompt(problem: Column | str, output: Column | str, answer: Column | str) -> Column:
    """What a judge is asked; a response without an answer is shown as not extracted."""
    return F.concat(
        F.lit("## Sample to Evaluate\n\n**Problem:**\n"), _col(problem),
        F.lit("\n\n**Generated Response:**\n"), _col(output),
        F.lit("\n\n**Extracted Answer:**\n"), F.coalesce(_col(answer), F.lit("(not extracted)")),
        F.lit("\n\nPlease evaluate this sample according to the criteria and provide:\n1. A score from 0.0 to 1.0\n2. Your reasoning\n3. A verdict: APPROVE or REJECT"),
    )


def is_retryable(status: Column | str, error: Column | str) -> Column:
    """Whether a failed attempt is worth another: not after success, a refused key (401) or an unknown model (404)."""
    status, error = _col(status), _col(error)
    by_status = F.when(status.between(200, 299), False).when(status.isin(401, 404), False).otherwise(True)
    return F.when(status.isNotNull(), by_status).otherwise(error.isin("timeout", "network", "rate_limited"))


def stable_id(*parts: Column | str) -> Column:
    """An id that a retried task makes again."""
    return F.sha2(F.concat_ws("\x01", *[_col(p).cast("string") for p in parts]), 256)
