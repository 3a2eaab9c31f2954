"""Numbers, running totals and parts of whole tables that no single task holds."""

import os
import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from judgeset.config import ModelSpec
from judgeset.operators import curate, exports, ledger, models, stats
from judgeset.operators.prefix import running
from judgeset.registry import _shared
from judgeset.sources import jsonl


@pytest.fixture
def small_partitions(spark):
    """Adaptive execution joins shuffle partitions as it would over a large table."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    usual = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in usual.items():
        spark.conf.set(k, v)


def test_an_aggregated_table_has_no_null_model_and_exact_shares(spark, small_partitions):
    df = spark.range(90_000).groupBy((F.col("id") % 30_000).cast("string").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.first(F.repeat(F.lit("x"), 50)).alias("text"))
    specs = [ModelSpec("a", weight=2), ModelSpec("b", weight=1), ModelSpec("zero", weight=0)]
    got = {r["model"]: r["count"] for r in models.assign_models(df, specs).groupBy("model").count().collect()}
    assert got == {"a": 20_000, "b": 10_000}


def test_numbers_follow_the_keys_alone(spark):
    keys = [None, "b", "a", "a", "ä", "Z", "b"] * 3
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "id string, n int")
    want = {None: 0, "Z": 1, "a": 2, "b": 3, "ä": 4}
    for parts in (1, 5):
        out, name = models.with_ordinal(df.repartition(parts), "i")
        rows = out.collect()
        assert len(rows) == 21 and {r["id"]: r[name] for r in rows} == want and {(r["id"], r[name]) for r in rows} == set(want.items())
    assert models.with_ordinal(df.limit(0))[0].count() == 0


def test_choice_by_cumulative_weight(spark):
    specs = [ModelSpec(f"m{i}", weight=w) for i, w in enumerate((0, 3, 0, 10**9, 1, 2, 0))]
    ends = list(accumulate(m.weight for m in specs))
    slots = [0, 2, 3, 4, 10**9 + 2, 10**9 + 3, 10**9 + 4, 10**9 + 5, None]
    df = spark.createDataFrame([(s,) for s in slots], "slot long")
    want = [None if s is None else next(m.id for m, e in zip(specs, ends) if s < e) for s in slots]
    assert [r["m"] for r in df.coalesce(1).select(models.choose(F.col("slot"), specs).alias("m")).collect()] == want


def test_running_totals(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(50)]), i, rng.choice([None, 1, -2, 5])) for i in range(2_000)]
    df = spark.createDataFrame(rows, "k int, i int, part int").repartition(7)
    got = {r["i"]: (r["s"], r["n"]) for r in running(df, ["k", "i"], {"s": F.col("part"), "n": F.lit(1)}, _shared(spark, "x")).collect()}
    want, total = {}, 0
    for n, (_, i, v) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), 1):
        total += v or 0
        want[i] = (total, n)
    assert got == want


def test_counters_after_every_operation(spark):
    problems = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    ops = spark.createDataFrame([(1, "a", "generated", None), (2, "b", "failed", None), (3, "a", "judged", "approve"), (4, "x", "generated", None), (5, "b", "judged", "reject")], "seq long, problem_id string, type string, verdict string")
    out = ledger.running_counters(problems, ops, _shared(spark, "c")).orderBy("seq").collect()
    assert [(r["seq"], *(r[s] for s in ledger.COUNTED)) for r in out] == [(1, 1, 1, 0, 0, 0), (2, 0, 1, 0, 0, 1), (3, 0, 0, 1, 0, 1), (5, 0, 0, 1, 1, 0)]


def test_a_large_problem_is_dealt_to_many_tasks(spark):
    """Whatever reads the texts of one problem reads a part of them, and nothing is missing."""
    df = spark.range(20_000).select(F.lit("hot").alias("problem_id"), F.col("id").cast("int").alias("response_idx"), F.lit("in").alias("input"), F.concat(F.lit("t"), F.col("id")).alias("output"), (F.col("id") % 10 / 10).alias("score"))
    df = df.unionByName(spark.createDataFrame([("b", 0, "in", "x", 0.5), (None, 0, "in", "y", 0.5)], "problem_id string, response_idx int, input string, output string, score double"))
    path, coalesce = _shared(spark, "grpo"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # which would join the few kilobytes of this test
    rows = exports.to_grpo(df, 100, path).collect()
    spark.conf.unset(coalesce)
    hot = sorted((r["part"], r["completions"]) for r in rows if r["problem_id"] == "hot")
    assert [p for p, _ in hot] == list(range(200)) and [t for _, c in hot for t in c] == [f"t{i}" for i in range(20_000)]
    assert sorted((r["problem_id"] or "", r["part"], r["completions"]) for r in rows if r["problem_id"] != "hot") == [("", 0, ["y"]), ("b", 0, ["x"])]
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 8_000


def test_parts_of_moderate_problems_need_no_second_table(spark, tmp_path):
    """Responses of a problem are cut into parts where they are grouped; ties and nulls as they were by ranges."""
    rows = [("a", i % 9, "in", f"t{i}", i / 10) for i in range(20)] + [("b", None, "in", "n", 0.1), ("b", 0, "other", "m", 0.2), (None, 1, "in", "x", 0.5)]
    df = spark.createDataFrame(rows, "problem_id string, response_idx int, input string, output string, score double").repartition(5)
    path = str(tmp_path / "grpo")
    got = {(r["problem_id"], r["part"]): (r["prompt"], r["completions"]) for r in exports.to_grpo(df, 3, path).collect()}
    a = sorted((r[1], r[4], r[3]) for r in rows if r[0] == "a")
    assert [got["a", p][1] for p in range(7)] == [[t for _, t in sorted((i, t) for i, _, t in a[k : k + 3])] for k in range(0, 20, 3)]
    assert got["b", 0] == ("other", ["n", "m"]) and got[None, 0] == ("in", ["x"]) and len(got) == 9
    assert not os.path.exists(path)


def test_bad_lines_are_named_by_file_and_line(spark, tmp_path):
    """Splits of a few hundred bytes, so that numbers add up over many tasks."""
    good = '{"id":"a","input":"x"}\n'
    (tmp_path / "1.jsonl").write_text(good * 100 + "\n" + '{"id":"b"\n' + good * 50 + '{"input":"x"}\n  \n' + good + '{"id":1,"input":null}')
    (tmp_path / "2.jsonl").write_text("[1]\r\n" + good.replace("\n", "\r\n") * 3 + "é\n")
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        rows, bad = jsonl.read_problems(spark, str(tmp_path))
        got = sorted((r["file"].rsplit("/", 1)[1], r["line"], r["reason"]) for r in bad.collect())
        assert got == [("1.jsonl", 102, "malformed"), ("1.jsonl", 153, "no id"), ("1.jsonl", 156, "no input"), ("2.jsonl", 1, "malformed"), ("2.jsonl", 5, "malformed")]
        assert rows.count() == 154
        with pytest.raises(ValueError, match=r'1\.jsonl, line 102: malformed: \{"id":"b"'):
            jsonl.load_problems(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_a_tier_is_read_from_its_folder_alone(spark, tmp_path):
    rows = [("a", 0.95, False, True), ("b", 0.95, True, True), ("c", 0.95, False, False), ("d", None, False, True)]
    df = spark.createDataFrame(rows, "id string, score double, t boolean, h boolean").select("id", "score", F.struct(F.col("t").alias("truncated"), F.col("h").alias("has_reasoning")).alias("quality_flags"))
    path = str(tmp_path / "tiers")
    curate.write_tiers(df, path)
    best = curate.read_tier(spark, path, "high_k")
    assert [r["id"] for r in best.collect()] == ["a"] and all("tier=high_k" in f for f in best.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tier" in plan and "Exchange" not in plan
    assert curate.read_tier(spark, path).count() == 4 and "Exchange" not in curate.confidence_tier(df)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="no such tier"):
        curate.read_tier(spark, path, "best")


def test_rollup_tells_null_keys_from_sums(spark):
    df = spark.createDataFrame([("e", "m", 1, 2, 0.5), ("e", None, 1, 2, 0.5), (None, None, 1, 2, None)], "endpoint string, model string, tokens_in long, tokens_out long, cost_usd double")
    got = {(r["endpoint"], r["model"], r["level"]): r["requests"] for r in stats.usage_rollup(df).collect()}
    assert got == {("e", "m", 0): 1, ("e", None, 0): 1, (None, None, 0): 1, ("e", None, 1): 2, (None, None, 1): 1, (None, None, 3): 3}
