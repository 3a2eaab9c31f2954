import pytest
from pyspark.sql import functions as F

from judgeset.registry import _as_stream, _shared


@pytest.mark.parametrize("parts, files", [(24, 24), (1, 3)])
def test_streams_keep_the_partitions_of_their_table(spark, parts, files):
    read = []

    def put(batch, batch_id):
        rows = batch.collect()
        read.append(({r["file"] for r in rows}, {r["id"] for r in rows}))

    stream = _as_stream(spark.range(2_400).repartition(parts), spark, "range").select("id", F.input_file_name().alias("file"))
    stream.writeStream.foreachBatch(put).option("checkpointLocation", _shared(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    assert len(read) == 3
    assert len(set().union(*(f for f, _ in read))) == files
    assert sum(len(ids) for _, ids in read) == 2_400 and set().union(*(ids for _, ids in read)) == set(range(2_400))


def test_operations_are_numbered_alike_on_every_try(spark):
    from judgeset.sources.commit import read_ops
    from judgeset.streaming import streams

    rows = [(f"s{i}", f"p{i % 3}", i / 10, "approve", 0.1) for i in range(12)]
    df = spark.createDataFrame(rows, "id string, problem_id string, score double, verdict string, judge_cost_usd double")
    found = []
    for parts in (4, 2):
        out, log = _shared(spark, "rows"), _shared(spark, "ops")
        streams.stream_sft(_as_stream(df.repartition(parts), spark, "scored", batches=1), out, log, _shared(spark, "state")).awaitTermination()
        found.append(sorted((r["problem_id"], r["seq"], r["score"]) for r in read_ops(spark, log).collect()))
    assert found[0] == found[1] and len({(p, s) for p, s, _ in found[0]}) == 12


def test_final_pairs_drop_late_rows(spark):
    from judgeset.streaming import streams

    path, out, state = (_shared(spark, x) for x in ("in", "out", "state"))
    schema = "sample_id string, problem_id string, response_idx int, score double, model string, at timestamp"

    def add(*rows):
        spark.createDataFrame([(f"s{i}", "p", i, s, "m") for i, s, _ in rows], schema.rsplit(",", 1)[0]).join(spark.createDataFrame([(i, t) for i, _, t in rows], "response_idx int, t string"), "response_idx").selectExpr("sample_id", "problem_id", "response_idx", "score", "model", "cast(t as timestamp) as at").write.mode("append").parquet(path)
        streams.final_pairs(spark.readStream.schema(schema).parquet(path), "at", "0 seconds", "1 hour").writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
        return sorted((str(r["window"]["start"]), r["chosen"]["score"], r["responses"]) for r in spark.read.parquet(out).collect())

    first = add((0, 0.5, "2024-01-01 00:10:00"), (1, 0.9, "2024-01-01 00:20:00"), (2, 0.1, "2024-01-01 02:00:00"))
    assert [x[1:] for x in first] == [(0.9, 2)]
    later = add((3, 1.0, "2024-01-01 00:30:00"), (4, 0.7, "2024-01-01 04:00:00"))  # the first is too late for its window
    assert [x[1:] for x in later] == [(0.9, 2), (0.1, 1)]


def test_many_small_batches_leave_few_folders(spark, tmp_path):
    """Equal to a plain dictionary after every batch; folders stay bounded, and a batch that comes again changes nothing."""
    import random

    from judgeset.streaming.levels import KEEP, LeveledTable

    rng, want, fan = random.Random(4), {}, 3
    table = LeveledTable(spark, str(tmp_path / "t"), "id", fan)
    assert table.read("id int, n int").count() == 0
    for batch in range(40):
        rows = {rng.randrange(30): batch * 100 + i for i in range(rng.randrange(6))}
        df = spark.createDataFrame(list(rows.items()), "id int, n int").coalesce(1)
        assert table.upsert(df, batch)
        want |= rows
        if batch % 7 == 0:
            assert not table.upsert(spark.createDataFrame([(1, -1)], "id int, n int"), batch)
    state = table.manifest()
    assert state["high"] == 39 and len(state["runs"]) <= (fan - 1) * 4
    assert len(list((tmp_path / "t").glob("level-*"))) <= len(state["runs"]) + KEEP * (fan + 2)
    assert {r["id"]: r["n"] for r in table.read().collect()} == want
    lows = sorted((r["low"], r["high"]) for r in state["runs"])
    assert lows[0][0] == 0 and all(a[1] + 1 == b[0] for a, b in zip(lows, lows[1:]))


def test_a_writer_that_broke_off_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    from judgeset.streaming import levels

    table = levels.LeveledTable(spark, str(tmp_path / "t"), "id", 2)
    frame = lambda n: spark.createDataFrame([(1, n)], "id int, n int")
    table.upsert(frame(0), 0)

    def breaks(*args):
        raise RuntimeError("gone")

    write = levels.files.write_text
    monkeypatch.setattr(levels.files, "write_text", breaks)
    with pytest.raises(RuntimeError):
        table.upsert(frame(1), 1)
    assert [r["n"] for r in table.read().collect()] == [0]
    monkeypatch.setattr(levels.files, "write_text", write)
    assert table.upsert(frame(2), 1) and [r["n"] for r in table.read().collect()] == [2]
    assert len(list((tmp_path / "t").glob("level-*"))) <= 3


def test_sessions_merge_close_and_drop_late_rows(spark):
    from judgeset.streaming import streams

    path, folder, state = (_shared(spark, x) for x in ("in", "out", "state"))
    schema = "problem_id string, response_idx int, score double, at string"

    def add(*rows):
        df = spark.createDataFrame(rows, schema).selectExpr("concat('s', response_idx) AS sample_id", "problem_id", "response_idx", "score", "'m' AS model", "cast(at AS timestamp) AS at")
        df.coalesce(1).write.mode("append").parquet(path)
        streams.stream_session_pairs(spark.readStream.schema(df.schema).parquet(path), "at", "2 hours", "1 hour", folder, state).awaitTermination()
        pairs, few = streams.read_sessions(spark, folder)
        return sorted((r["problem_id"], r["chosen"]["response_idx"], r["rejected"]["response_idx"], r["responses"]) for r in pairs.collect()), sorted((r["problem_id"], r["responses"], r["reason"]) for r in few.collect())

    day = "2024-01-01 "
    assert add(("p", 0, 0.2, day + "00:00:00"), ("p", 1, 0.9, day + "01:40:00"), ("q", 2, 0.5, day + "00:10:00")) == ([], [])
    few = lambda *ids: [(i, 1, "insufficient_samples") for i in ids]
    assert add(("r", 10, 0.3, day + "02:00:00"), ("r", 11, 0.8, day + "03:30:00")) == ([], few("p", "q"))
    assert add(("r", 12, 0.6, day + "02:50:00")) == ([], few("p", "q"))  # joins the two sessions of r
    assert add(("z", 4, 0.1, day + "12:00:00"), ("q", 5, 1.0, day + "00:20:00")) == ([("r", 11, 10, 3)], few("p", "p", "q"))  # q's is too late


def test_a_ledger_in_levels_equals_the_folded_log(spark, tmp_path):
    """Operations of a problem are spread over many batches, out of order; null scores and repeated batches too."""
    import random

    from judgeset.operators import ledger
    from judgeset.streaming import levels

    rng = random.Random(9)
    kinds = [("generated", None), ("judged", "approve"), ("judged", "reject"), ("failed", None)]
    rows = []
    for seq in range(400):
        kind, verdict = rng.choice(kinds)
        rows.append((seq, f"p{rng.randrange(25)}", kind, "m" if kind == "generated" else None, 0.5 if kind == "generated" else None, rng.choice([None, 0.7]) if kind == "judged" else None, verdict, 0.1 if kind == "judged" else None, f"r{seq}" if kind == "failed" else None, None))
    ops = spark.createDataFrame(rows, "seq long, problem_id string, type string, model string, cost double, score double, verdict string, judge_cost double, reason string, at timestamp")
    table = levels.ledger_table(spark, str(tmp_path / "l"), 2)
    for batch in range(6):
        part = ops.filter(f"seq * 7 % 6 = {batch}").coalesce(1)
        assert levels.append_ops(table, part, batch) and not levels.append_ops(table, part, batch)
    got = sorted(levels.ledger_state(table).drop("score").collect())
    assert got == sorted(ledger.fold_ops(ops).drop("score").collect())
    last = {}
    for seq, p, kind, _, _, score, *_ in rows:
        if kind == "judged":
            last[p] = score
    assert {r["id"]: r["score"] for r in levels.ledger_state(table).collect()} == {p: last.get(p) for p in {r[1] for r in rows}}
