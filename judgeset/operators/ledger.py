"""The ledger of what has been processed, folded from an append-only log of operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.operators.prefix import running

STATUSES = ("pending", "generated", "approved", "rejected", "failed", "retrypending")


def init_ledger(problems: DataFrame) -> DataFrame:
    """Every problem pending; ids that repeat are one problem."""
    return fold_ledger(problems, None)


def one_each(problems: DataFrame, order: str | None = None) -> DataFrame:
    """One row per id: of rows that share one the last by the column order, else the greatest by their columns as JSON.

    Repeated ids are looked for among hashes of the ids; if there are any, rows are shuffled once. Rows without an id are
    left as they are.
    """
    repeated = problems.filter("id IS NOT NULL").groupBy(F.xxhash64("id").alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.limit(1).count():
        return problems
    by = F.struct(*([order] if order else []), F.to_json(F.struct(*problems.columns)))
    one = problems.filter("id IS NOT NULL").groupBy("id").agg(F.max_by(F.struct(*problems.columns), by).alias("x")).select("x.*")
    return problems.filter("id IS NULL").unionByName(one)


def fold_ops(ops: DataFrame) -> DataFrame:
    """State of each problem that the log names, in one pass that combines before the shuffle."""
    of = lambda kind, value: F.max_by(value, F.when(F.col("type") == kind, F.col("seq")))
    status = F.when(F.col("type") == "generated", "generated").when(F.col("type") == "failed", "retrypending").when(F.col("verdict") == "approve", "approved").otherwise("rejected")
    return ops.groupBy(F.col("problem_id").alias("id")).agg(
        F.max_by(status, "seq").alias("status"), of("judged", "score").alias("score"), of("generated", "model").alias("model"),
        of("generated", "cost").alias("gen_cost"), of("judged", "judge_cost").alias("judge_cost"),
        F.count_if(F.col("type") == "failed").cast("int").alias("retry_count"), of("failed", "reason").alias("retry_reason"), F.max_by("at", "seq").alias("updated_at"),
    )


def done_ids(ops: DataFrame) -> DataFrame:
    """id of each problem whose last operation is neither a generation nor a failure: those that fold_ops has as approved
    or rejected. Only a flag per problem is kept, so that the log is hashed and not sorted."""
    done = ~F.coalesce(F.col("type").isin("generated", "failed"), F.lit(False))
    return ops.groupBy(F.col("problem_id").alias("id")).agg(F.max_by(done, "seq").alias("done")).filter("done").select("id")


def partial_fold(ops: DataFrame) -> DataFrame:
    """What a part of the log says about each problem it names, so that parts can be merged in any order: the last
    operation of each kind with its seq, the last of all, and the number of failures."""
    of = lambda kind, *values: F.max(F.when(F.col("type") == kind, F.struct("seq", *values)))
    return ops.groupBy(F.col("problem_id").alias("id")).agg(
        of("generated", "model", "cost").alias("generated"), of("judged", "score", "judge_cost").alias("judged"), of("failed", "reason").alias("failed"),
        F.max(F.struct("seq", _status().alias("status"), "at")).alias("last"), F.count_if(F.col("type") == "failed").alias("failures"),
    )


def merge_folds(parts: DataFrame) -> DataFrame:
    """One row per problem from the rows of several partial folds."""
    return parts.groupBy("id").agg(*[F.max(c).alias(c) for c in ("generated", "judged", "failed", "last")], F.sum("failures").alias("failures"))


def unfold(folds: DataFrame) -> DataFrame:
    """Partial folds, one row per problem, as fold_ops gives them."""
    return folds.select(
        "id", "last.status", "judged.score", "generated.model", F.col("generated.cost").alias("gen_cost"), "judged.judge_cost",
        F.col("failures").cast("int").alias("retry_count"), F.col("failed.reason").alias("retry_reason"), F.col("last.at").alias("updated_at"),
    )


def _status() -> Column:
    return F.when(F.col("type") == "generated", "generated").when(F.col("type") == "failed", "retrypending").when(F.col("verdict") == "approve", "approved").otherwise("rejected")


def with_problems(problems: DataFrame, states: DataFrame) -> DataFrame:
    """One row per problem with its state, as fold_ops or unfold gives it; pending where there is none."""
    return problems.select("id").dropDuplicates(["id"]).join(states, "id", "left").select(
        "id", F.coalesce("status", F.lit("pending")).alias("status"), "score", "model", F.coalesce("gen_cost", F.lit(0.0)).alias("gen_cost"),
        F.coalesce("judge_cost", F.lit(0.0)).alias("judge_cost"), F.coalesce("retry_count", F.lit(0)).alias("retry_count"), "retry_reason", "updated_at",
    )


def fold_ledger(problems: DataFrame, ops: DataFrame | None) -> DataFrame:
    """One row per problem; operations on unknown problems are ignored."""
    ids = problems.select("id").dropDuplicates(["id"])
    null = lambda kind: F.lit(None).cast(kind)
    if ops is None:
        return ids.select("id", F.lit("pending").alias("status"), null("double").alias("score"), null("string").alias("model"), F.lit(0.0).alias("gen_cost"), F.lit(0.0).alias("judge_cost"), F.lit(0).alias("retry_count"), null("string").alias("retry_reason"), null("timestamp").alias("updated_at"))
    return with_problems(problems, fold_ops(ops))


def compact(snapshot: DataFrame, ops: DataFrame, high_water: int) -> DataFrame:
    """The ledger after the operations past high_water are laid over a snapshot, so the log can be cut there."""
    new = fold_ops(ops.filter(F.col("seq") > high_water)).select("id", *[F.col(c).alias(f"new_{c}") for c in ("status", "score", "model", "gen_cost", "judge_cost", "retry_count", "retry_reason", "updated_at")])
    both = snapshot.join(new, "id", "left")
    later = lambda c: F.coalesce(f"new_{c}", c).alias(c)
    return both.select("id", later("status"), later("score"), later("model"), later("gen_cost"), later("judge_cost"), (F.col("retry_count") + F.coalesce("new_retry_count", F.lit(0))).alias("retry_count"), later("retry_reason"), later("updated_at"))


def filter_pending(problems: DataFrame, ledger: DataFrame, include_new: bool = False, stuck_as_pending: bool = False) -> DataFrame:
    """Problems still to be done. Problems that the ledger does not know are left out unless include_new; generated
    ones that never got judged count only with stuck_as_pending."""
    waiting = ["pending", "retrypending", *(["generated"] if stuck_as_pending else [])]
    found = problems.join(ledger.filter(F.col("status").isin(waiting)).select("id"), "id", "left_semi")
    return found.unionByName(problems.join(ledger.select("id"), "id", "left_anti")) if include_new else found


def retry_pending(ledger: DataFrame) -> DataFrame:
    return ledger.filter("status = 'retrypending'").select("id", "retry_count", "retry_reason")


def apply_retry_limit(ledger: DataFrame, limit: int) -> DataFrame:
    """Problems that failed limit times or more and wait for a retry are failed for good."""
    return ledger.withColumn("status", F.when((F.col("status") == "retrypending") & (F.col("retry_count") >= limit), "failed").otherwise(F.col("status")))


def ledger_stats(ledger: DataFrame, ops: DataFrame) -> DataFrame:
    """One row: problems by status, costs over all operations (repeats add up), progress and whether all is done."""
    count = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    states = ledger.agg(F.count(F.lit(1)).alias("total"), *count).withColumn("one", F.lit(1))
    known = ops.join(ledger.select(F.col("id").alias("problem_id")), "problem_id", "left_semi")
    costs = known.agg(F.coalesce(F.sum(F.when(F.col("type") == "generated", F.col("cost"))), F.lit(0.0)).alias("gen_cost"), F.coalesce(F.sum(F.when(F.col("type") == "judged", F.col("judge_cost"))), F.lit(0.0)).alias("judge_cost")).withColumn("one", F.lit(1))
    progress = F.coalesce(F.try_divide((F.col("approved") + F.col("rejected") + F.col("failed")) * 100.0, F.col("total")), F.lit(100.0))
    done = (F.col("pending") == 0) & (F.col("generated") == 0) & (F.col("retrypending") == 0)
    return states.join(costs, "one").drop("one").withColumn("progress_percent", progress).withColumn("is_complete", done)


def replay_counters(ops: DataFrame) -> DataFrame:
    """Per problem and operation the status before and after it, for counters that depend on both."""
    status = F.when(F.col("type") == "generated", "generated").when(F.col("type") == "failed", "retrypending").when(F.col("verdict") == "approve", "approved").otherwise("rejected")
    w = W.partitionBy("problem_id").orderBy("seq")
    return ops.select("problem_id", "seq", F.coalesce(F.lag(status).over(w), F.lit("pending")).alias("before"), status.alias("after"))


COUNTED = ("pending", "generated", "approved", "rejected", "retrypending")


def running_counters(problems: DataFrame, ops: DataFrame, path: str) -> DataFrame:
    """(seq, problem_id, and a count for each status): how many problems have each status after every operation.

    All problems start as pending; operations on unknown ones are left out. Operations of one seq follow each other by
    problem. The log is replayed per problem, and the changes are added up over the whole log by ranges of seq.
    """
    known = ops.join(problems.select(F.col("id").alias("problem_id")).distinct(), "problem_id", "left_semi")
    total = problems.select("id").distinct().agg(F.count(F.lit(1)).alias("all")).first()["all"]
    change = lambda s: (F.when(F.col("after") == s, 1).otherwise(0) - F.when(F.col("before") == s, 1).otherwise(0)).cast("bigint")
    out = running(replay_counters(known), ["seq", "problem_id"], {s: change(s) for s in COUNTED}, path)
    return out.select("seq", "problem_id", *[(F.col(s) + (total if s == "pending" else 0)).alias(s) for s in COUNTED])
