import pytest
from pyspark.sql import functions as F

from judgeset.functions import text as T


def values(spark, rows, *cols):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [tuple(r)[0] if len(cols) == 1 else tuple(r) for r in df.orderBy("i").select(*cols).collect()]


def test_extract_answer(spark):
    cases = [
        ("x <answer> 4 </answer>", "4"),
        ("<answer></answer>", ""),
        ("<answer>a\nb</answer>", "<answer>a\nb</answer>"),
        ("## Answer\n42", "42"),
        ("## Answer\n\n42", "42"),
        ("## Answer\n42\n## Next", "42"),
        ("## Answer\n42\n", "## Answer\n42"),
        ("p1\n\n p2 \n\n  ", "p2"),
        ("", None),
        ("  \n\n ", None),
        ("a\n\n" + "x" * 600, "x" * 500),
        (None, None),
        ("<answer>one</answer> <answer>two</answer>", "one"),
        ("   z ", "z"),
    ]
    assert values(spark, [c for c, _ in cases], T.extract_answer("x")) == [e for _, e in cases]
    assert values(spark, ["<answer>a\nb</answer>"], T.extract_answer("x", dotall=True)) == ["a\nb"]


def test_truncated(spark):
    no, yes = ["", "The end.", "done **", "The end.  \n", "a)", 'say "x"'], ["The end...", "abc", "x -", "note:", "Wait", "fin。"]
    assert values(spark, no + yes, T.is_truncated("x")) == [False] * len(no) + [True] * len(yes)


def test_flags(spark):
    got = values(spark, ["Step 1 \\boxed{4}", "Wait, no", "plain", "**Answer** K_i"], T.quality_flags("x"))
    assert [(g["has_answer_tags"], g["has_reasoning"], g["self_correction"]) for g in got] == [(True, True, False), (False, False, True), (False, False, False), (True, True, False)]


def test_reasoning_length(spark):
    assert values(spark, ["é<answer>x", "abc## Answer", "## Answer <answer>", "éé"], T.reasoning_length("x")) == [2, 3, 10, 4]


SCORES = [
    ("Score: 0.85", 0.85), ("**Score:** 0.85", 0.85), ("overall score 0.85", 0.85), ("**Score**: 0.9", 0.9), ("Score: 85", 1.0), ("Rated 1.0", 1.0), ("Score: 1", 1.0),
    ('{"scores":{"completeness":0.6},"overall_score":0.9}', 0.6), ("Score: -0.5", 0.5), ("rated 10.5", 0.5), ("Rated 1", None), ("Score: .9", None), ("none", None),
    ("Score range 0.0 to 1.0; Score: 0.8", 0.8), ("Score: 5.", 1.0),
]


def test_parse_score(spark):
    assert values(spark, [c for c, _ in SCORES], T.parse_score("x")) == [e for _, e in SCORES]
    assert values(spark, ["none"], T.score_or_default("x")) == [0.5]


def test_parse_verdict(spark):
    cases = [("Approved", 0.1, "approve"), ("DISAPPROVE", 0.1, "approve"), ("approve or reject", 0.1, "approve"), ("NOT APPROVE; REJECT", 0.9, "reject"), ("reject", 0.9, "reject"), ("NOT APPROVE", 0.5, "reject"), ("NOT APPROVE", 0.9, "approve"), ("needs_revision", 0.85, "approve")]
    df = spark.createDataFrame(cases, "x string, s double, e string")
    assert df.filter(T.parse_verdict("x", "s", 0.85) != F.col("e")).count() == 0


def test_rubric(spark):
    whole = '{"scores":{"completeness":%s,"accuracy":0.9,"reasoning_validity":0.9,"answer_correctness":%s,"clarity":0.9},"overall_score":%s}'
    rows = ["```json\n" + whole % (0.7, 0.9, 0.85) + "\n```", "so: " + whole % (0.6, 0.8, 0.9), whole % (0.6, 0.7, 0.9), "nothing", '{"overall_score":0.9}', None]
    assert values(spark, rows, T.rubric_verdict(T.parse_rubric("x"))) == ["approve", "needs_revision", "reject", None, None, None]


@pytest.mark.parametrize(("status", "error", "again"), [(200, None, False), (401, None, False), (404, None, False), (429, None, True), (500, None, True), (None, "timeout", True), (None, "network", True), (None, "parse", False)])
def test_retryable(spark, status, error, again):
    df = spark.createDataFrame([(status, error)], "status int, error string")
    assert df.select(T.is_retryable("status", "error")).first()[0] is again
