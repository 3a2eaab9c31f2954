"""A store of paid answers, keyed by request."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from judgeset.sources.files import exists, matching

Batches = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
ANSWERS = "request_id string, body string, error string, time_ms bigint, at timestamp"
#: Tasks that one job of asking has, or those of one bucket if they are more.
TASKS = 4096
#: From so many tasks on, tasks ask more than every requests where the model is quick, but are no fewer than that.
MANY = 512
#: Seconds of the model's time that such a task takes at most, as far as can be told from what was asked before.
SPAN = 1.0


def _asked(fn: Batches, seconds: Accumulator | None = None, answered: Accumulator | None = None, odd: Accumulator | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """fn for the rows (bucket, request_id, body; request if it is to come back) of one task: each id is asked once, and
    answers get their bucket, their request and their time, fn's own or the batch's by the number of its rows. A request
    that fn passes over gets an answer without a body.

    seconds and answered count what fn took and how many requests it had; odd counts rows that are not one answer to
    one request: ids that repeat, and answers to what was answered before (they come without their request).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: dict[str, int] = {}  # of every request so far
        waiting: dict[int, tuple[pa.RecordBatch, dict[str, int]]] = {}  # batches with requests that have no answer yet, and their rows
        fed, strange, kind = 0.0, 0, None

        def unseen() -> Iterator[pd.DataFrame]:
            nonlocal fed, strange, kind
            began = time.time()
            for k, b in enumerate(batches):
                kind = b.schema.field("request").type if "request" in b.schema.names else None
                ids = b.column("request_id").to_pylist()
                rows = {i: j for j, i in enumerate(ids) if i not in buckets} if len(set(ids)) < len(ids) or not buckets.keys().isdisjoint(ids) else dict(zip(ids, range(len(ids)), strict=True))
                strange += len(ids) - len(rows)
                if rows:
                    buckets.update(zip(ids, b.column("bucket").to_pylist(), strict=True))
                    waiting[k] = (b, rows)
                    frame = b.select(["request_id", "body"])
                    frame = (frame if len(rows) == len(ids) else frame.take(pa.array(rows.values()))).to_pandas()
                    fed += time.time() - began
                    yield frame
                    began = time.time()
            fed += time.time() - began

        def taken(ids: list[str]) -> pa.Array | None:
            """The requests of these ids, which wait no longer."""
            places = []
            for k, (b, rows) in list(waiting.items()):
                if len(rows) == len(b) == len(ids) and ids == list(rows):  # the usual case, a batch as it was given
                    del waiting[k]
                    return None if kind is None else b.column("request")
            for i in ids:
                k = next(k for k, (_, rows) in waiting.items() if i in rows)
                places.append((k, waiting[k][1].pop(i)))
            of = {k: waiting[k][0] for k in sorted({k for k, _ in places})}
            for k in of:
                if not waiting[k][1]:
                    del waiting[k]
            if kind is None:
                return None
            start, n = {}, 0
            for k, b in of.items():
                start[k], n = n, n + len(b)
            return pa.concat_arrays([b.column("request") for b in of.values()]).take(pa.array([start[k] + j for k, j in places]))

        def answers(out: pd.DataFrame, each, known: bool = True) -> pa.RecordBatch:
            """The rows of a frame; known: with their requests, which wait."""
            ids = out["request_id"].tolist()
            text = lambda c: pa.Array.from_pandas(out[c], type=pa.string()) if c in out else pa.nulls(len(out), pa.string())
            ms = pa.Array.from_pandas(each, type=pa.int64(), safe=False) if isinstance(each, pd.Series) else pa.array([each] * len(out), pa.int64())
            at = pa.array([pd.Timestamp.now(tz="UTC").to_pydatetime()] * len(out), pa.timestamp("us", tz="UTC"))
            columns = {"request_id": pa.array(ids, pa.string()), "body": text("body"), "error": text("error"), "time_ms": ms, "at": at, "bucket": pa.array([buckets[i] for i in ids], pa.int32())}
            requests = taken(ids) if known else None
            if kind is not None:
                columns["request"] = pa.nulls(len(ids), kind) if requests is None else requests
            return pa.RecordBatch.from_pydict(columns)

        took, began = 0.0, time.time()
        for out in fn(unseen()):
            took += time.time() - began
            out = out.reset_index(drop=True)
            each = out["time_ms"] if "time_ms" in out else int((time.time() - began) * 1000 / max(1, len(out)))
            left = [rows for _, rows in waiting.values()]
            fresh = ~out["request_id"].duplicated() & pd.Series([any(i in rows for rows in left) for i in out["request_id"]] if len(left) != 1 else [i in left[0] for i in out["request_id"]], dtype=bool)
            if fresh.all():
                if len(out):
                    yield answers(out, each)
            else:
                again = ~fresh & out["request_id"].isin(buckets.keys())
                strange += int(again.sum())
                for chosen, known in ((fresh, True), (again, False)):
                    if chosen.any():
                        yield answers(out[chosen], each[chosen] if isinstance(each, pd.Series) else each, known)
            began = time.time()
        took += time.time() - began
        silent = [i for _, rows in waiting.values() for i in rows]
        if silent:
            yield answers(pd.DataFrame({"request_id": silent}, dtype="object"), None)
        for counter, value in ((seconds, took - fed), (answered, len(buckets)), (odd, strange)):
            if counter is not None:
                counter.add(value)

    return run


class AnswerStore:
    """Answers under path, in folders by bucket, a hash of the problem (or whatever key the requests are dealt by).

    A batch of problems takes whole buckets, so it reads and writes only their folders, however many answers the others
    hold. A task asks about every requests or so, and a task's answers are in the store as soon as the task
    ends: a crash inside a batch loses those of the tasks that were still running. Each task costs time of its own, so
    where there are very many and the model is so quick that it takes far less than SPAN seconds for them, a task asks
    what is answered in that time; a model that takes its time is asked every requests a task. A request that was answered twice, as
    when an executor is lost after its task had written, counts once: a good answer before a failed one, then the newest.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, every: int = 64):
        others = [p for p in matching(spark, f"{path}/of=*") if not p.endswith(f"/of={buckets}")]
        if others:
            raise ValueError(f"{path} was begun with another number of buckets: {others[0].rsplit('=', 1)[1]}")
        self.spark, self.root, self.buckets, self.every = spark, f"{path}/of={buckets}", buckets, every
        self.turn, self.odd = "", spark.sparkContext.accumulator(0)
        self.seconds, self.answers = spark.sparkContext.accumulator(0.0), spark.sparkContext.accumulator(0)

    def bucket(self, key: Column | str) -> Column:
        return bucket_of(key, self.buckets)

    def read(self, wanted: Iterable[int] | None = None) -> DataFrame:
        """One row per request asked so far in the wanted buckets (all by default): its answer, or its last error."""
        if not exists(self.spark, self.root):
            return self.spark.createDataFrame([], f"{ANSWERS}, bucket int")
        rows = self.spark.read.schema(f"{ANSWERS}, bucket int").parquet(self.root)
        if wanted is not None:
            rows = rows.filter(F.col("bucket").isin(list(wanted)))
        said, good = _said()
        said = F.struct(F.struct(*said).alias("said"), "bucket")
        # dealt by request_id alone, so that a join with the requests moves the answers no second time
        one = rows.repartition("request_id").groupBy("request_id").agg(F.max_by(said, F.struct(good.alias("good"), "at")).alias("x"))
        return one.select("request_id", "x.said.*", "x.bucket")

    def answered(self, wanted: Iterable[int] | None = None, what: Column | None = None) -> DataFrame:
        """request_id of the good answers, once each; or what of each of their rows."""
        if not exists(self.spark, self.root):
            return self.spark.createDataFrame([], "request_id string").select("request_id" if what is None else what)
        rows = self.spark.read.schema(f"{ANSWERS}, bucket int").parquet(self.root)
        rows = rows if wanted is None else rows.filter(F.col("bucket").isin(list(wanted)))
        good = rows.filter("body IS NOT NULL AND error IS NULL")
        return good.select("request_id").distinct() if what is None else good.select(what)

    def ask(self, requests: DataFrame, fn: Batches, wanted: Iterable[int] | None = None) -> DataFrame:
        """Answers of fn to requests (request_id, body, bucket), which all lie in the wanted buckets. Those with a good
        answer are not asked again, and equal request ids are asked once.

        Jobs follow each other, each over so many buckets that it has about TASKS tasks: the driver keeps every task of a
        job that runs, so it would run full if one job asked everything. Answers are looked for by request id alone;
        bodies are joined with them only if some requests have theirs.
        """
        wanted = list(range(self.buckets) if wanted is None else wanted)
        self._ask_left(requests.select("bucket", "request_id", "body"), fn, wanted)
        return self.read(wanted)

    def answer(self, requests: DataFrame, fn: Batches, columns: list[str], wanted: Iterable[int] | None = None) -> DataFrame:
        """The columns of requests, as in ask, with request_id, body, error, time_ms and at of their answers.

        Requests go with their answers, so that nothing has to be looked for afterwards. Only where that does not give
        each request one answer, as when some were answered before, a task was run twice or requests repeat, the two
        are joined by request id.
        """
        wanted = list(range(self.buckets) if wanted is None else wanted)
        left = requests.select("bucket", "request_id", "body", F.struct(*columns).alias("request"))
        number, new = self._ask_left(left, fn, wanted)
        if new and number:
            kind = StructType([*_parse_datatype_string(f"{ANSWERS}, asked string, bucket int").fields, left.schema["request"]])
            rows = self.spark.read.schema(kind).parquet(self.root).filter(F.col("bucket").isin(wanted) & (F.col("asked") == self.turn))
            if self.odd.value == 0 and rows.count() == number:
                return rows.select("request.*", "request_id", *_said()[0])
        return requests.select("request_id", *columns).join(self.read(wanted).drop("bucket"), "request_id", "left")

    def _ask_left(self, left: DataFrame, fn: Batches, wanted: list[int]) -> tuple[int, bool]:
        """Asks what has no good answer; (number of requests, whether none of them had one)."""
        self.turn, self.odd = uuid.uuid4().hex, self.spark.sparkContext.accumulator(0)
        number, fresh = left.count(), True
        if number and self._begun(wanted):
            # by a hash, which is enough to say that nothing was answered
            known = self.answered(wanted, F.xxhash64("request_id").alias("h"))
            if left.select(F.xxhash64("request_id").alias("h")).join(known, "h", "left_semi").limit(1).count():
                new = left.join(self.answered(wanted), "request_id", "left_anti")
                unasked = new.select("request_id").count()
                fresh = unasked == number
                left, number = (left if fresh else new), unasked
        rest = wanted
        while rest:
            tasks = -(-number // self._size(number))
            chunks = max(1, -(-tasks // len(wanted)))  # tasks of one bucket; few requests leave several buckets to one task
            trial = tasks > MANY and not self.answers.value  # how quick the model is shows in one bucket
            at_once = 1 if trial else max(1, TASKS // chunks)
            mine, rest = rest[:at_once], rest[at_once:]
            self._ask(left if len(mine) == len(wanted) else left.filter(F.col("bucket").isin(mine)), fn, mine, chunks, max(1, min(tasks, len(mine))))
        return number, fresh

    def _size(self, number: int) -> int:
        """Requests of a task."""
        if not self.answers.value:
            return self.every
        quick = SPAN * self.answers.value / max(self.seconds.value, 1e-6)
        return max(self.every, int(min(quick, number / MANY)))

    def _begun(self, wanted: list[int]) -> bool:
        names = {p.rsplit("=", 1)[1] for p in matching(self.spark, f"{self.root}/bucket=*")}
        return any(str(b) in names for b in wanted)

    def _ask(self, left: DataFrame, fn: Batches, wanted: list[int], chunks: int, spread: int) -> None:
        place = F.array_position(F.array(*[F.lit(b) for b in wanted]), F.col("bucket")) - 1
        task = (F.floor(place * spread / len(wanted)) * chunks + F.pmod(F.xxhash64("request_id", F.lit(7)), F.lit(chunks))).cast("int")
        kind = StructType([*_parse_datatype_string(f"{ANSWERS}, bucket int").fields, *[f for f in left.schema.fields if f.name == "request"]])
        asked = left.repartitionById(spread * chunks, task).mapInArrow(_asked(fn, self.seconds, self.answers, self.odd), kind).withColumn("asked", F.lit(self.turn))
        # by this version of the committer a task's files are there for good when it ends, not when the job ends
        asked.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("bucket").parquet(self.root)


def _said() -> tuple[list[Column], Column]:
    """(body, error, time_ms, at) of a stored answer, and whether it is a good one."""
    good = F.col("body").isNotNull() & F.col("error").isNull()
    return [F.when(good, F.col("body")).alias("body"), F.when(~good, F.coalesce("error", F.lit("no_response"))).alias("error"), F.col("time_ms"), F.col("at")], good


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(5)), F.lit(buckets)).cast("int")
