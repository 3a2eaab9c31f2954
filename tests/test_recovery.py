"""Runs and commits that break off, and ids that repeat."""

import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from judgeset import schemas
from judgeset.config import ModelSpec
from judgeset.operators import ledger, requests
from judgeset.operators.ledger import one_each
from judgeset.plans import workloads
from judgeset.sources import answers, commit, files
from judgeset.sources.answers import AnswerStore

GENS, JUDGES = [ModelSpec("g")], [ModelSpec("j")]
ANSWER = json.dumps({"choices": [{"message": {"role": "assistant", "content": "<answer>a</answer>"}}]})
REVIEW = workloads.replay(lambda body: (json.dumps({"choices": [{"message": {"role": "assistant", "content": "Score: 0.9 APPROVE"}}]}), None))


def problems(spark, *ids):
    return spark.createDataFrame([(i, f"in {i} {n}", None) for n, i in enumerate(ids)], schemas.PROBLEMS)


def counted(spark, refused=()):
    asked = spark.sparkContext.accumulator(0)

    def fn(batches):
        for b in batches:
            asked.add(len(b))
            yield pd.DataFrame({"request_id": b["request_id"], "body": [None if any(f"in {x} " in t for x in refused) else ANSWER for t in b["body"]], "error": ["timeout" if any(f"in {x} " in t for x in refused) else None for t in b["body"]]}, dtype="object")

    return asked, fn


@pytest.mark.parametrize("run", [workloads.run_sft, workloads.run_dpo])
def test_repeated_ids_are_one_problem(spark, tmp_path, run):
    asked, fn = counted(spark)
    out = run(problems(spark, "a", "a", "b", "a"), GENS, JUDGES, ("s", "j"), fn, REVIEW, str(tmp_path / "run")).collect()
    if run is workloads.run_sft:
        assert sorted((r["problem_id"], r["input"]) for r in out) == [("a", "in a 3"), ("b", "in b 2")] and asked.value == 2
    else:
        assert asked.value == 6
    ops = commit.read_ops(spark, str(tmp_path / "run/ledger")).filter("type = 'generated'")
    assert sorted(r["problem_id"] for r in ops.collect()) == ["a", "b"]


def test_the_last_row_of_an_id_counts(spark):
    df = spark.createDataFrame([("a", "z", 1), ("a", "b", 3), ("a", "c", 2), ("b", "x", 9), (None, "u", 1), (None, "v", 1)], "id string, input string, n int")
    got = sorted((r["id"] or "", r["input"]) for r in one_each(df, "n").collect())
    assert got == [("", "u"), ("", "v"), ("a", "b"), ("b", "x")]
    assert [r["input"] for r in one_each(df.filter("id = 'a'")).collect()] == ["z"]
    assert one_each(df.limit(0)).count() == 0


def test_equal_requests_are_asked_once_and_answered_once(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "s"), buckets=4, every=3)
    asked, fn = counted(spark)
    rows = [(f"r{i % 10}", f"in x{i % 10} ", i % 10 % 4) for i in range(50)]
    df = spark.createDataFrame(rows, "request_id string, body string, bucket int").repartition(5)
    assert sorted(r["request_id"] for r in store.ask(df, fn).collect()) == [f"r{i}" for i in range(10)] and asked.value == 10
    # an answer written twice, a failure after it, and a bucket that nobody asked for
    store.read().filter("request_id = 'r1'").withColumn("body", F.lit(None).cast("string")).withColumn("error", F.lit("late")).unionByName(store.read().filter("request_id = 'r1'")).write.mode("append").partitionBy("bucket").parquet(store.root)
    again = {r["request_id"]: r["error"] for r in store.read([1]).collect()}
    assert again == {"r1": None, "r5": None, "r9": None}
    store.ask(df, fn)
    assert asked.value == 10
    plan = store.read([1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    with pytest.raises(ValueError, match="another number of buckets: 4"):
        AnswerStore(spark, str(tmp_path / "s"), buckets=8)


def test_a_crash_inside_a_batch_keeps_what_was_paid(spark, tmp_path):
    """One batch; one of its tasks breaks after the others have ended."""
    folder, total = str(tmp_path / "run"), 120
    asked, fn = counted(spark)

    def broken(batches):
        for b in batches:
            if any("in p7 " in t for t in b["body"]):
                time.sleep(6)
                raise RuntimeError("the executor is gone")
            yield from fn(iter([b]))

    df = problems(spark, *[f"p{i}" for i in range(total)])
    run = lambda model: workloads.run_sft(df, GENS, JUDGES, ("s", "j"), model, REVIEW, folder, buckets=16, every=4)
    with pytest.raises(Exception, match="the executor is gone"):
        run(broken)
    paid = AnswerStore(spark, f"{folder}/generated", 16).answered().count()
    assert total // 2 < paid < total
    before = asked.value
    assert run(fn).count() == total
    assert asked.value - before == total - paid


def test_failures_of_a_batch_are_listed_once(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "run")
    _, fn = counted(spark, refused=("a", "b"))
    go = lambda: workloads.run_sft(problems(spark, "a", "b", "c"), GENS, JUDGES, ("s", "j"), fn, REVIEW, folder)
    seal = commit.seal

    def breaks(*args):
        raise RuntimeError("before the manifest")

    monkeypatch.setattr(commit, "seal", breaks)
    with pytest.raises(RuntimeError):
        go()
    assert workloads.failures(spark, folder).count() == 0
    monkeypatch.setattr(commit, "seal", seal)
    assert [r["problem_id"] for r in go().collect()] == ["c"]
    assert sorted(r["problem_id"] for r in workloads.failures(spark, folder).collect()) == ["a", "b"]


def _tables(spark, n):
    rows = spark.createDataFrame([(f"p{i}", i) for i in range(n)], "id string, n int")
    ops = spark.createDataFrame([(i, 0, "judged", f"p{i}", None, None, 0.9, "approve", 0.1, None, None, None) for i in range(n)], schemas.OPS)
    return rows, ops


def test_an_empty_second_try_shows_no_rows(spark, tmp_path):
    out, log = str(tmp_path / "o"), str(tmp_path / "l")
    commit.stage(_tables(spark, 10)[0], out, 0, commit.new_try())  # broke off
    commit.commit_batch(*_tables(spark, 0), out, log, 0)
    assert commit.committed(spark, out, log, _tables(spark, 0)[0].schema).count() == 0
    commit.commit_batch(*_tables(spark, 3), out, log, 1)
    commit.commit_batch(*_tables(spark, 2), out, log, 1)
    assert commit.committed(spark, out, log).count() == 2 and commit.read_ops(spark, log).count() == 2


def test_commit_abort_and_recover(spark, tmp_path):
    out, log = str(tmp_path / "o"), str(tmp_path / "l")
    schema = _tables(spark, 0)[0].schema
    assert commit.committed(spark, out, log, schema).count() == 0 and commit.recover(spark, [out, log], commit.manifest_of(log)) == 0
    attempt = commit.new_try()
    commit.stage(_tables(spark, 4)[0], out, 3, attempt)
    commit.abort(spark, [out, log], 3, attempt)
    assert not os.path.exists(f"{out}/batch_id=3/try={attempt}")
    for n in (5, 4):
        commit.commit_batch(*_tables(spark, n), out, log, 3)
    commit.stage(_tables(spark, 9)[0], out, 4, commit.new_try())
    assert commit.recover(spark, [out, log], commit.manifest_of(log)) == 3  # both tables of the replaced try, and the orphan
    assert commit.recover(spark, [out, log], commit.manifest_of(log)) == 0
    assert commit.committed(spark, out, log).count() == 4
    assert len(files.matching(spark, f"{out}/batch_id=*/try=*")) == 1


def test_a_failed_commit_leaves_nothing(spark, tmp_path):
    out, log = str(tmp_path / "o"), str(tmp_path / "l")
    rows, ops = _tables(spark, 3)
    with pytest.raises(Exception, match="no such operation"):
        commit.commit_batch(rows, ops.withColumn("reason", F.raise_error(F.lit("no such operation")).cast("string")), out, log, 0)
    assert files.matching(spark, f"{out}/batch_id=*/try=*") == [] and commit.committed(spark, out, log, rows.schema).count() == 0


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_asking_is_split_into_jobs_of_few_tasks(spark, tmp_path, monkeypatch):
    """Every job stays small, each request is asked once, and a bucket of problems is one file whatever read them."""
    monkeypatch.setattr(answers, "TASKS", 6)
    asked, fn = counted(spark)
    sizes, ask = [], AnswerStore._ask

    def seen(self, left, fn, wanted, chunks, spread):
        sizes.append(chunks * spread)
        ask(self, left, fn, wanted, chunks, spread)

    monkeypatch.setattr(AnswerStore, "_ask", seen)
    df = problems(spark, *[f"p{i}" for i in range(200)]).repartition(6)
    out = workloads.run_dpo(df, GENS, JUDGES, ("s", "j"), fn, REVIEW, str(tmp_path / "run"), buckets=8, every=50)
    assert out.count() == 0 and asked.value == 600  # equal scores give no pair
    assert len(sizes) >= 4 and max(sizes) <= 6
    assert len(files.matching(spark, f"{tmp_path}/run/pending/bucket=*/part-*")) == 8
    ops = commit.read_ops(spark, str(tmp_path / "run/ledger"))
    assert {r["type"]: r["count"] for r in ops.groupBy("type").count().collect()} == {"generated": 200, "judged": 200}


def test_stored_answers_and_requests_are_moved_once(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "s"), buckets=2)
    df = spark.createDataFrame([("r1", "in x ", 0), ("r2", "in y ", 1)], "request_id string, body string, bucket int")
    got = store.ask(df, counted(spark)[1])
    assert _shuffles(got) == 1
    merge = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(merge, "-1")
    met = requests.match_responses(df.withColumn("model", F.lit("g")), got.drop("bucket"), GENS)
    assert _shuffles(met) == 2 and met.filter("error IS NULL").count() == 2
    spark.conf.unset(merge)


def test_rows_of_repeated_ids_are_moved_once(spark):
    df = spark.createDataFrame([("a", "z", 1), ("a", "b", 3), (None, "u", 1), ("b", "x", 9)], "id string, input string, n int")
    got = one_each(df, "n")
    assert sorted((r["id"] or "", r["input"]) for r in got.collect()) == [("", "u"), ("a", "b"), ("b", "x")]
    assert _shuffles(one_each(df, "n")) == 1


def test_requests_go_with_their_answers(spark, tmp_path):
    """No join where each request has one answer of this call; the same rows where some repeat or were asked before."""
    rows = [(f"r{i}", f"in x{i} ", i % 4, i, {"n": str(i)}) for i in range(40)]
    df = spark.createDataFrame(rows, "request_id string, body string, bucket int, n int, m map<string,string>")
    echo = lambda frames: (pd.DataFrame({"request_id": b["request_id"], "body": "good " + b["body"]}, dtype="object") for b in frames)
    get = lambda got: sorted((r["request_id"], r["n"], r["m"]["n"], r["body"], r["error"]) for r in got.collect())
    right = sorted((r, n, str(n), f"good {b}", None) for r, b, _, n, _ in rows)
    got = AnswerStore(spark, str(tmp_path / "a"), buckets=4, every=3).answer(df, echo, ["n", "m"])
    assert _shuffles(got) == 0 and get(got) == right
    store = AnswerStore(spark, str(tmp_path / "b"), buckets=4, every=3)
    assert get(store.answer(df.filter("n < 7"), echo, ["n", "m"])) == [r for r in right if r[1] < 7]
    got = store.answer(df, echo, ["n", "m"])
    assert _shuffles(got) > 0 and get(got) == right
    assert store.read().count() == 40
    twice = df.unionByName(df.filter("n % 5 = 0").withColumn("n", F.col("n") + 100))
    got = AnswerStore(spark, str(tmp_path / "c"), buckets=4, every=30).answer(twice, echo, ["n"])
    assert sorted((r["request_id"], r["n"], r["body"]) for r in got.collect()) == sorted([(r, n, f"good {b}") for r, b, _, n, _ in rows] + [(r, n + 100, f"good {b}") for r, b, _, n, _ in rows if n % 5 == 0])


def test_answers_out_of_step_keep_their_requests(spark, tmp_path):
    def odd(frames):
        """Frames in which a request is passed over, one is answered twice, and answers come in another order and late."""
        kept = []
        for b in frames:
            kept.append(b)
            if len(kept) == 2:
                got = pd.concat(kept)
                got = got[~got["body"].str.contains("in x3 ")].iloc[::-1]
                yield pd.DataFrame({"request_id": got["request_id"], "body": "good " + got["body"], "error": None}, dtype="object")
                kept.clear()
        got = pd.concat(kept) if kept else pd.DataFrame({"request_id": [], "body": []})
        yield pd.DataFrame({"request_id": got["request_id"], "body": "good " + got["body"].astype("object"), "error": None}, dtype="object")
        if len(got):
            yield pd.DataFrame({"request_id": got["request_id"].head(1), "body": None, "error": "late"}, dtype="object")

    rows = [(f"r{i}", f"in x{i} ", 0, i) for i in range(30)]
    df = spark.createDataFrame(rows, "request_id string, body string, bucket int, n int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    got = AnswerStore(spark, str(tmp_path / "s"), buckets=1, every=30).answer(df, odd, ["n"])
    found = {r["request_id"]: (r["n"], r["body"], r["error"]) for r in got.collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found.pop("r3") == (3, None, "no_response") and len(found) == 29 and got.count() == 30
    assert all(v == (int(k[1:]), f"good in x{k[1:]} ", None) for k, v in found.items())


@pytest.mark.parametrize("slow", [False, True])
def test_a_quick_model_gets_larger_tasks(spark, tmp_path, monkeypatch, slow):
    monkeypatch.setattr(answers, "MANY", 8)
    monkeypatch.setattr(answers, "SPAN", 0.05)
    asked, fn = counted(spark)
    sizes, ask = [], AnswerStore._ask

    def seen(self, left, fn, wanted, chunks, spread):
        sizes.append(chunks * spread)
        ask(self, left, fn, wanted, chunks, spread)

    def sleeps(frames):
        for b in frames:
            time.sleep(0.01 * len(b) if slow else 0)
            yield from fn(iter([b]))

    monkeypatch.setattr(AnswerStore, "_ask", seen)
    df = spark.range(400).selectExpr("concat('r', id) AS request_id", "concat('in x', id, ' ') AS body", "cast(id % 4 AS int) AS bucket")
    store = AnswerStore(spark, str(tmp_path / "s"), buckets=4, every=5)
    assert store.ask(df, sleeps).count() == 400 and asked.value == 400
    assert sizes[0] == 20 and (sum(sizes) == 80 if slow else sum(sizes) < 60), sizes


def test_a_batch_looks_for_answers_in_its_own_buckets(spark, tmp_path, monkeypatch):
    looked = []
    answered = AnswerStore.answered
    monkeypatch.setattr(AnswerStore, "answered", lambda self, *a: (looked.append(a), answered(self, *a))[1])
    _, fn = counted(spark)
    go = lambda: workloads.run_sft(problems(spark, *"abcdefgh"), GENS, JUDGES, ("s", "j"), fn, REVIEW, str(tmp_path / "run"), batches=2, buckets=4)
    assert go().count() == 8 and not looked


def test_done_ids_are_those_of_the_fold(spark):
    ops = spark.createDataFrame([("a", 1, "generated", None), ("a", 2, "judged", "approve"), ("b", 3, "judged", "reject"), ("b", 4, "failed", None), ("c", 5, "generated", None), ("d", 6, "judged", "reject"), ("e", 7, "failed", None), ("e", 8, "judged", None)], "problem_id string, seq bigint, type string, verdict string")
    whole = ops.selectExpr("*", "null AS score", "null AS model", "null AS cost", "null AS judge_cost", "null AS reason", "null AS at")
    done = {r["id"] for r in ledger.fold_ops(whole).filter("status IN ('approved', 'rejected', 'failed')").collect()}
    assert {r["id"] for r in ledger.done_ids(ops).collect()} == done == {"a", "d", "e"}
