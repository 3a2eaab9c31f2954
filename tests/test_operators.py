import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from judgeset import schemas
from judgeset.config import EnsembleConfig, GenerationConfig, ModelSpec, check_responses
from judgeset.operators import curate, dpo, exports, judging, ledger, models, ratelimit, requests
from judgeset.plans import workloads
from judgeset.sources import commit, jsonl


def results(spark, *groups):
    rows = [(str(g), i, s, v, f"r{i}", m, None, 10 + i, 0.5) for g, js in enumerate(groups) for i, (s, v, m) in enumerate(js)]
    return spark.createDataFrame(rows, schemas.JUDGE_RESULTS).repartition(3)


A, R = "approve", "reject"


def test_ensemble_scores_and_confidence(spark):
    df = results(spark, [(0.9, A, "a"), (0.85, A, "a"), (0.3, R, "a")], [(0.8, A, "a"), (0.8, R, "a")], [(0.9, A, "a"), (0.5, A, "a"), (0.9, A, "a")], [(0.7, R, "a")], [(0.80, A, "a"), (0.81, A, "a"), (0.79, R, "a")])
    got = {r["sample_id"]: r for r in judging.ensemble(df, EnsembleConfig(enabled=True)).collect()}
    assert got["0"]["score"] == 0.85 and round(got["0"]["score_std_dev"], 4) == 0.2718 and got["0"]["verdict"] == A and got["0"]["confidence"] == "low"
    assert (got["1"]["score"], got["1"]["verdict"], got["1"]["confidence"]) == (0.8, R, "medium")
    assert (got["2"]["verdict"], got["2"]["confidence"]) == (A, "low")
    assert (got["3"]["verdict"], got["3"]["confidence"], got["3"]["num_judges"]) == (R, "high", 1)
    assert (got["4"]["verdict"], got["4"]["confidence"]) == (A, "medium")
    assert got["0"]["judge_models"] == "a,a,a" and got["0"]["judge_cost_usd"] == 1.5 and got["0"]["judge_time_ms"] == 12 and got["0"]["reasoning"] == "r0"
    assert got["0"]["individual_scores"] == [0.9, 0.85, 0.3]


def test_weighted_average(spark):
    specs = [ModelSpec("two", weight=2), ModelSpec("one"), ModelSpec("none", weight=0)]
    df = results(spark, [(0.9, A, "two"), (0.6, A, "one")], [(0.9, A, "none"), (0.6, A, "none")], [(0.9, A, "two"), (0.6, A, "unknown")])
    got = {r["sample_id"]: round(r["score"], 9) for r in judging.ensemble(df, EnsembleConfig(enabled=True, strategy="weightedaverage"), specs).collect()}
    assert got == {"0": 0.8, "1": 0.75, "2": 0.8}


def test_hierarchical(spark):
    df = results(spark, [(0.9, A, "a"), (0.1, R, "a")], [(0.7, A, "a"), (0.1, R, "a"), (0.2, R, "a")], [(0.39, R, "a")])
    cfg = EnsembleConfig(enabled=True, hierarchical=True)
    got = {r["sample_id"]: (r["score"], r["num_judges"], r["judge_cost_usd"]) for r in judging.evaluate(df, cfg).collect()}
    assert got == {"0": (0.9, 1, 0.5), "1": (0.2, 3, 1.5), "2": (0.39, 1, 0.5)}
    cheap = df.filter("judge_ordinal = 0")
    assert {r["sample_id"]: r["judge_cost_usd"] for r in judging.hierarchical(cheap, df, cfg, include_cheap_cost=True).collect()}["1"] == 2.0


def judged(spark, **scores):
    rows = [(f"{p}_{i}", p, i, s, f"m{i}", f"{p} text {i}") for p, ss in scores.items() for i, s in enumerate(ss)]
    return spark.createDataFrame(rows, "sample_id string, problem_id string, response_idx int, score double, model string, output string").repartition(4)


def test_pairs(spark):
    df = judged(spark, a=[0.9, 0.9, 0.5, 0.5], b=[0.9, 0.8], c=[0.6, 0.5], d=[0.5, 0.7], e=[0.5])
    problems = spark.createDataFrame([(p, f"in {p}", None) for p in "abcde"], schemas.PROBLEMS)
    got = {r["problem_id"]: (r["chosen"], r["rejected"]) for r in dpo.dpo_pairs(df, problems).collect()}
    assert got == {"a": ("a text 0", "a text 3"), "d": ("d text 1", "d text 0")}
    ranks = {r["sample_id"]: r["rank"] for r in dpo.preference_rank(df).collect()}
    assert [ranks[f"a_{i}"] for i in range(4)] == [1, 2, 3, 4]
    short = {r["problem_id"]: r["reason"] for r in dpo.insufficient(problems.withColumnRenamed("id", "problem_id"), df, df.filter("sample_id != 'b_0'")).collect()}
    assert short == {"e": "insufficient_samples", "b": "judgment_failed"}
    assert {tuple(r["scores"]) for r in exports.to_grpo(df.withColumn("input", F.lit("x"))).collect()} >= {(0.9, 0.9, 0.5, 0.5)}


def test_pairs_move_no_text_twice(spark):
    """One shuffle of the responses, combined before it, and one of the problems."""
    df = spark.createDataFrame([("a", "a0", 0, 0.9, "m", "best"), ("a", "a1", 1, 0.2, "m", None), ("b", "b0", 0, 0.9, "m", "x")], "problem_id string, sample_id string, response_idx int, score double, model string, output string")
    problems = spark.createDataFrame([("a", "in", None), ("b", "in", None)], "id string, input string, metadata string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    pairs = dpo.dpo_pairs(df, problems)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r["problem_id"], r["chosen"], r["rejected"]) for r in pairs.collect()] == [("a", "best", None)]


def test_slots(spark):
    df = spark.range(6).select(F.col("id").cast("string").alias("id"), F.col("id").alias("o"))
    specs = [ModelSpec("x", weight=2), ModelSpec("y", weight=1)]
    assert [r["model"] for r in models.assign_models(df, specs, ordinal="o").orderBy("o").collect()] == ["x", "x", "y"] * 2
    assert sorted(r["model"] for r in models.assign_models(df, specs).collect()) == ["x"] * 4 + ["y"] * 2
    assert {r["model"] for r in models.assign_models(df, specs, method="hash").collect()} <= {"x", "y"}
    with pytest.raises(ValueError):
        models.assign_models(df, [ModelSpec("x", weight=0)], ordinal="o")
    with pytest.raises(ValueError):
        check_responses(1)
    assert models.cheapest_model([ModelSpec("p", input_price_per_1m=1.0), ModelSpec("q", output_price_per_1m=1.0)]).id == "p"
    assert models.endpoints([ModelSpec("p"), ModelSpec("q", endpoint="z"), ModelSpec("r")]) == ["openrouter", "z"]


def test_ledger_is_independent_of_partitions(spark):
    rows = [(1, "generated", "a", "m1", 1.0, None, None, None, None), (2, "judged", "a", None, None, 0.9, "approve", 0.5, None), (3, "failed", "b", None, None, None, None, None, "generation_failed"), (4, "failed", "b", None, None, None, None, None, "judgment_failed"), (5, "generated", "zzz", "m1", 9.0, None, None, None, None), (6, "generated", "c", "m2", 2.0, None, None, None, None)]
    ops = spark.createDataFrame([(s, 0, t, p, m, c, sc, v, jc, None, r, None) for s, t, p, m, c, sc, v, jc, r in rows], schemas.OPS)
    problems = spark.createDataFrame([(x, "i", None) for x in "aabcd"], schemas.PROBLEMS)
    for n in (1, 5):
        got = {r["id"]: r for r in ledger.fold_ledger(problems, ops.repartition(n)).collect()}
        assert {k: v["status"] for k, v in got.items()} == {"a": "approved", "b": "retrypending", "c": "generated", "d": "pending"}
        assert (got["b"]["retry_count"], got["b"]["retry_reason"], got["a"]["model"], got["a"]["score"]) == (2, "judgment_failed", "m1", 0.9)
    led = ledger.fold_ledger(problems, ops)
    s = ledger.ledger_stats(led, ops).first()
    assert (s["gen_cost"], s["judge_cost"], s["progress_percent"], s["is_complete"]) == (3.0, 0.5, 25.0, False)
    assert sorted(r["id"] for r in ledger.filter_pending(problems.dropDuplicates(["id"]), led, stuck_as_pending=True).collect()) == ["b", "c", "d"]
    assert {r["id"] for r in ledger.apply_retry_limit(led, 2).filter("status = 'failed'").collect()} == {"b"}
    more = spark.createDataFrame([("new", "i", None)], schemas.PROBLEMS)
    assert [r["id"] for r in ledger.filter_pending(more, led, include_new=True).collect()] == ["new"]
    assert ledger.init_ledger(problems).filter("status = 'pending'").count() == 4


def test_jsonl(spark, tmp_path):
    path = tmp_path / "p.jsonl"
    path.write_text('{"id":"a","input":"x","metadata":{"k":[1,2]},"other":1}\n\n  \n{"id":"b","input":"y"}\n')
    df = jsonl.load_problems(spark, str(path))
    assert {(r["id"], r["input"], r["metadata"]) for r in df.collect()} == {("a", "x", '{"k":[1,2]}'), ("b", "y", None)}
    jsonl.write_jsonl(df, str(tmp_path / "out"))
    lines = sorted(x for f in (tmp_path / "out").glob("part-*") for x in f.read_text().splitlines())
    assert lines == ['{"id":"a","input":"x","metadata":{"k":[1,2]}}', '{"id":"b","input":"y"}']
    for bad in ('{"id":"a"}', '{"id":"a",'):
        path.write_text(bad + "\n")
        with pytest.raises(Exception):  # noqa: B017
            jsonl.load_problems(spark, str(path)).collect()


def test_commit_twice_is_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "id string, n int")
    ops = spark.createDataFrame([(1, 0, "judged", "a", None, None, 0.9, "approve", 0.1, None, None, None)], schemas.OPS)
    out, log = str(tmp_path / "o"), str(tmp_path / "l")
    for batch in (0, 1, 1):
        commit.commit_batch(rows, ops, out, log, batch)
    commit.stage(rows, out, 7, commit.new_try())  # broke off before its operations
    assert sorted(r["batch_id"] for r in commit.committed(spark, out, log).collect()) == [0, 1]


def test_requests_and_answers(spark):
    tasks = spark.createDataFrame([("t1", "1+1?"), ("t2", None)], "id string, input string")
    asked = requests.generation_requests(tasks, [ModelSpec("m", input_price_per_1m=1e6)], "sys")
    body = json.loads(asked.filter("id = 't1'").first()["body"])
    assert body["messages"][1]["content"] == "Solve the following problem:\n\n1+1?\n\nProvide your reasoning and final answer." and body["model"] == "m"
    answer = '{"choices":[{"message":{"role":"assistant","content":"2"}}],"usage":{"prompt_tokens":3,"completion_tokens":1,"total_tokens":4}}'
    replies = asked.filter("id = 't1'").select("request_id", F.lit(answer).alias("body"))
    ok, failed = requests.ingest_responses(asked, replies, [ModelSpec("m", input_price_per_1m=1e6)])
    row = ok.first()
    assert (row["content"], row["tokens_in"], row["cost_usd"]) == ("2", 3, 3.0)
    assert [r["error"] for r in failed.collect()] == ["no_response"]
    attempts = spark.createDataFrame([("a", 0, 429, None, None), ("a", 1, 200, None, answer), ("b", 0, 401, None, None), ("b", 1, 200, None, answer), ("c", 0, None, "timeout", None), ("d", 0, 200, None, "oops")], "request_id string, attempt int, status int, error string, body string")
    assert {r["request_id"]: (r["outcome"], r["attempts_used"]) for r in requests.resolve_attempts(attempts).collect()} == {"a": ("success", 2), "b": ("refused", 1), "c": ("exhausted", 1), "d": ("parse_error", 1)}


def test_backoff_carries_over_chunks(spark):
    status = [429, 429, 500, 429, 200, 429, 429, 429, 429, 429, 429, 429, 200, 429]
    want, n = [], 0
    for s in status:
        n = n + 1 if s == 429 else 0 if s < 400 else n
        want.append((n, min(2.0**n, 60.0) if s == 429 else None))
    rows = [(f"{i:03d}", "e", "m", (pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)).to_pydatetime(), s) for i, s in enumerate(status)]
    df = spark.createDataFrame(rows, "request_id string, endpoint string, model string, ts timestamp, status int")
    for chunk in ("1 day", "2 hours", "1 hour"):
        got = [(r["consecutive_429"], r["backoff_secs"]) for r in ratelimit.backoff_timeline(df, chunk=chunk).orderBy("request_id").collect()]
        assert got == want


def test_backoff_keeps_every_row(spark):
    t = pd.Timestamp("2024-01-01").to_pydatetime()
    rows = [("1", None, None, t, 429, 0), ("2", None, None, None, 429, 1), ("3", "e", "m", None, 429, 2), ("4", "e", "m", t, 200, 3), ("5", "e", "m", t, None, 4)]
    df = spark.createDataFrame(rows, "request_id string, endpoint string, model string, ts timestamp, status int, k int")
    got = {r["request_id"]: (r["consecutive_429"], r["backoff_secs"], r["k"]) for r in ratelimit.backoff_timeline(df).collect()}
    assert got == {"1": (2, 4.0, 0), "2": (1, 2.0, 1), "3": (1, 2.0, 2), "4": (0, None, 3), "5": (0, None, 4)}
    assert ratelimit.backoff_timeline(df.limit(0)).count() == 0


def test_models_keep_the_columns_of_their_table(spark):
    df = spark.range(9).select(F.col("id").cast("string").alias("id"), F.col("id").alias("o"), *[F.lit(i).alias(c) for i, c in enumerate(("slot", "given", "part", "place", "ordinal", "_slot"))]).repartition(4)
    specs = [ModelSpec("x", weight=2), ModelSpec("y", weight=1)]
    for out in (models.assign_models(df, specs, ordinal="o"), models.assign_models(df, specs), models.assign_models(df, specs, method="hash")):
        assert out.columns == [*df.columns, "model"]
        rows = out.collect()
        assert len(rows) == 9 and {(r["slot"], r["given"], r["part"], r["place"], r["ordinal"], r["_slot"]) for r in rows} == {tuple(range(6))}
    numbered, name = models.with_ordinal(df, "n")
    assert numbered.columns == [*df.columns, "n"]
    assert sorted(r[name] for r in numbered.collect()) == list(range(9))


def test_large_groups_are_reported_whole(spark):
    df = judged(spark, a=[0.1] * 5, b=[0.2] * 2).withColumn("input", F.concat(F.lit("in "), F.col("response_idx").cast("string")))
    got = sorted((r["problem_id"], r["part"], r["prompt"], r["completions"]) for r in exports.to_grpo(df, 4).collect())
    assert got == [("a", 0, "in 0", [f"a text {i}" for i in range(4)]), ("a", 1, "in 4", ["a text 4"]), ("b", 0, "in 0", ["b text 0", "b text 1"])]
    assert [(r["problem_id"], r["responses"]) for r in exports.oversized(df, 4).collect()] == [("a", 5)]


def test_trainer_files(spark, tmp_path):
    rows = spark.createDataFrame([("a \"q\"\n", "b", True)], "prompt string, completion string, label boolean")
    exports.write_trainer(rows, str(tmp_path / "k"), "kto", {"prompt": "input", "completion": "output"})
    lines = [json.loads(x) for f in (tmp_path / "k").glob("part-*") for x in f.read_text().splitlines()]
    assert lines == [{"input": "a \"q\"\n", "output": "b", "label": True}] and list(lines[0]) == ["input", "output", "label"]
    with pytest.raises(ValueError, match="no such field"):
        exports.write_trainer(rows, str(tmp_path / "x"), "kto", {"chosen": "c"})
    with pytest.raises(Exception, match="a row has no completion"):
        exports.write_trainer(rows.withColumn("completion", F.lit(None).cast("string")), str(tmp_path / "y"), "kto")


def test_tiers(spark):
    rows = [("a", 0.95, False, True), ("b", 0.95, True, True), ("c", 0.95, False, False), ("d", 0.5, False, True)]
    df = spark.createDataFrame(rows, "id string, score double, t boolean, h boolean").select("id", "score", F.struct(F.col("t").alias("truncated"), F.col("h").alias("has_reasoning")).alias("quality_flags"))
    assert [r["tier"] for r in curate.confidence_tier(df).orderBy("id").collect()] == ["high_k", "low_i", "med_b", "low_i"]
    assert [r["id"] for r in curate.high_confidence(df).collect()] == ["a"]


def _model(reply):
    def fn(batches):
        for b in batches:
            bodies = [json.dumps({"choices": [{"message": {"role": "assistant", "content": reply(x)}}], "usage": {"prompt_tokens": 1, "completion_tokens": 1, "total_tokens": 2}}) for x in b["body"]]
            yield pd.DataFrame({"request_id": b["request_id"], "body": bodies, "error": None})

    return fn


def test_workloads(spark, tmp_path):
    problems = spark.createDataFrame([("math_1", "1+1", None), ("math_2", "2+2", '{"k":1}')], schemas.PROBLEMS)
    gens, judges = [ModelSpec("g1"), ModelSpec("g2")], [ModelSpec("j1"), ModelSpec("j2")]
    ask = _model(lambda b: "Step 1 <answer>" + ("good" if '"g1"' in b else "bad") + "</answer>")
    review = _model(lambda b: "Score: 0.9 APPROVE" if "<answer>good" in b else "Score: 0.2 REJECT")
    out = workloads.run_sft(problems, gens[:1], judges, ("s", "j"), ask, review, str(tmp_path / "sft"), GenerationConfig(), EnsembleConfig(enabled=True))
    assert {(r["problem_id"], r["answer"], r["score"], r["num_judges"]) for r in out.collect()} == {("math_1", "good", 0.9, 3), ("math_2", "good", 0.9, 3)}
    pairs = workloads.run_dpo(problems, gens, judges, ("s", "j"), ask, review, str(tmp_path / "dpo"), n=3).collect()
    assert {(p["problem_id"], p["chosen_score"], p["rejected_score"]) for p in pairs} == {("math_1", 0.9, 0.2), ("math_2", 0.9, 0.2)}
    assert all("good" in p["chosen"] and "bad" in p["rejected"] for p in pairs)


def _tasks(spark, ids):
    return spark.createDataFrame([(i, f"in {i}", None) for i in ids], schemas.PROBLEMS)


def test_a_restart_asks_only_what_is_unanswered(spark, tmp_path):
    """Batch 2 of the first run breaks; the second run asks the rest once, and the failed problem again."""
    folder, asked = str(tmp_path / "run"), spark.sparkContext.accumulator(0)
    gens, judges = [ModelSpec("g")], [ModelSpec("j")]

    def model(broken, refused):
        def fn(batches):
            for b in batches:
                asked.add(len(b))
                if any(f"in {x}\\n" in body for body in b["body"] for x in broken):
                    raise RuntimeError("the model is gone")
                says = [(None, "timeout") if any(f"in {x}\\n" in body for x in refused) else (json.dumps({"choices": [{"message": {"role": "assistant", "content": "<answer>a</answer>"}}]}), None) for body in b["body"]]
                yield pd.DataFrame({"request_id": b["request_id"], "body": [x for x, _ in says], "error": [e for _, e in says], "time_ms": 7}, dtype="object")

        return fn

    review = _model(lambda b: "Score: 0.9 APPROVE")
    ids = [f"p{i}" for i in range(20)]
    problems = _tasks(spark, ids)
    second = {r["id"] for r in problems.filter("pmod(xxhash64(id, 5), 2) = 1").collect()}
    gone, bad = sorted(second)[0], sorted(set(ids) - second)[0]
    run = lambda m: workloads.run_sft(problems, gens, judges, ("s", "j"), m, review, folder, batches=2)
    with pytest.raises(Exception):  # noqa: B017
        run(model([gone], [bad]))
    assert {r["problem_id"] for r in workloads.failures(spark, folder).collect()} == {bad}
    assert sorted(r["id"] for r in workloads.pending(problems, folder).collect()) == sorted(second | {bad})
    before = asked.value
    rows = run(model([], [])).collect()
    assert sorted(r["problem_id"] for r in rows) == sorted(ids) and {r["generation_time_ms"] for r in rows} == {7}
    assert asked.value - before == len(second) + 1
    run(model(ids, []))  # nothing is left to ask
    assert asked.value - before == len(second) + 1
    assert {(r["stage"], r["error"]) for r in workloads.failures(spark, folder).collect()} == {("generation", "timeout")}


def test_runs_without_any_answer(spark, tmp_path):
    none = workloads.replay(lambda body: (None, "refused"))
    for run, name in ((workloads.run_sft, "sft"), (workloads.run_dpo, "dpo")):
        assert run(_tasks(spark, ["a", "b"]), [ModelSpec("g")], [ModelSpec("j")], ("s", "j"), none, none, str(tmp_path / name)).count() == 0
        assert {(r["problem_id"], r["error"]) for r in workloads.failures(spark, str(tmp_path / name)).collect()} == {("a", "refused"), ("b", "refused")}
