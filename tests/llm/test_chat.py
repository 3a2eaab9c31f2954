import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from judgeset.llm.chat import Template, format_reply_trees, read_back


def test_query(against_oracle):
    against_oracle("op6_chat_formatting", "/root/testdata/sf0.001")


def _replace(t, s, escape):
    a, b = s, s[0] + "\\" + s[1:]
    return t.replace(a, b) if escape else t.replace(b, a)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|/s>[]INST\\ \nx", max_size=40))
def test_escaping_is_reversible(text):
    """The same replacements in Python: what holds for them holds for the expressions, which the next test runs."""
    t = Template()
    out = text.replace("\\", "\\\\")
    for s in t.controls:
        out = _replace(out, s, True)
    assert not any(s in out for s in t.controls)
    for s in t.controls[::-1]:
        out = _replace(out, s, False)
    assert out.replace("\\\\", "\\") == text


def test_escape_expressions(spark):
    t = Template()
    rows = ["<|turn|>", "<\\|", "</s>[INST] ok [/INST]", "\\", "\\\\<|", "a\nb", "", "<\\n>", "[\\INST]", "<" + "\\" * 5 + "|end|>"]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    for r in df.select("x", t.unescape(t.escape(F.col("x"))).alias("y"), t.unescape_role(t.escape_role(F.col("x"))).alias("z"), t.escape_role(F.col("x")).alias("e")).collect():
        assert r["x"] == r["y"] == r["z"] and "\n" not in r["e"]


TREE = [
    ("c", 1, None, "user", "q", 0.0), ("c", 2, 1, "assistant", "bad", 0.1), ("c", 3, 1, "assistant", "good", 0.9), ("c", 4, 3, "user", "more", 0.5), ("c", 5, 4, "assistant", "end", 0.8),
    ("d", 1, 99, "user", None, None), ("d", 2, 2, None, "self", None), (None, 7, None, "user", "null conv", 1.0), ("e", 1, 2, "user", "loop", 1.0), ("e", 2, 1, "user", "loop", 1.0),
]


def test_trees(spark):
    df = spark.createDataFrame([(*r, 5) for r in TREE], "conv_id string, node_id long, parent_id long, role string, text string, score double, leaf int")
    best = format_reply_trees(df, score="score").collect()
    assert {(r["conv_id"], r["leaf"], r["n_turns"]) for r in best} == {("c", 5, 4), ("d", 1, 1), (None, 7, 1)}
    c = next(r for r in best if r["conv_id"] == "c")
    assert c["formatted"] == "<|turn|>user\nq<|end|><|turn|>assistant\ngood<|end|><|turn|>user\nmore<|end|><|turn|>assistant\nend<|end|>"
    assert [c["formatted"][s["start"] : s["start"] + s["length"]] for s in c["loss_spans"]] == ["good", "end"]
    assert round(c["path_score"], 6) == 0.55
    both = format_reply_trees(df, score="score", top_k=2).filter("conv_id = 'c'").orderBy("path_rank").collect()
    assert [(r["leaf"], r["path_rank"]) for r in both] == [(5, 1), (2, 2)]
    assert format_reply_trees(df.limit(0)).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 7, 33, 300])
def test_long_chains_and_repeats(spark, depth):
    rows = [("c", i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(depth)]
    df = spark.createDataFrame(rows + rows[:1], "conv_id string, node_id long, parent_id long, role string, text string")
    got = read_back(format_reply_trees(df)).first()
    assert got["n_turns"] == depth
    assert got["loss_chars"] == sum(len(r[4]) for r in rows if r[3] == "assistant")


def test_the_loss_is_read_from_the_formatted_string(spark):
    """A span that is off by one shows in the digests."""
    df = spark.createDataFrame([("c", 1, None, "user", "q"), ("c", 2, 1, "assistant", "an <|answer|>")], "conv_id string, node_id long, parent_id long, role string, text string")
    good = format_reply_trees(df)
    shifted = good.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s.start + 1).alias("start"), s.length.alias("length"))))
    a, b = read_back(good).first(), read_back(shifted).first()
    assert a["loss_chars"] == len("an <|answer|>") and a["turns_sha256"] == b["turns_sha256"] and a["loss_sha256"] != b["loss_sha256"]
