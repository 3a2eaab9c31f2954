"""Upserts kept as levels of sorted runs, so that many small batches leave few folders.

The newest row of a key counts, or what a merge of the caller's makes of all its rows, as for a ledger whose runs are
partial folds of the log.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.operators.ledger import merge_folds, partial_fold, unfold
from judgeset.sources import files
from judgeset.sources.commit import new_try

KEEP = 3


def ledger_table(spark: SparkSession, path: str, fan: int = 8) -> LeveledTable:
    """A ledger that is read from a few folders however many batches it has: runs are partial folds of the operations.
    append_ops adds a batch, ledger_state reads the state of each problem."""
    return LeveledTable(spark, path, "id", fan, merge_folds)


def append_ops(table: LeveledTable, ops: DataFrame, batch_id: int) -> bool:
    return table.upsert(partial_fold(ops), batch_id)


def ledger_state(table: LeveledTable) -> DataFrame:
    """As fold_ops over all operations that were appended."""
    return unfold(table.read())


class LeveledTable:
    """The newest row of each key, over batches of updated rows that are numbered upwards.

    A batch becomes a run of level 0, sorted by key. fan runs of one level are merged into one of the next, in which the
    newest row of each key stays, so there are at most fan - 1 runs a level and one more level for each fan times as many
    batches: every row is rewritten once a level, and a reader opens O(fan log batches) folders. A small manifest, written
    whole under the next number, names the runs that count and the high-water mark, the last batch that they hold; batches
    up to the mark are passed over, so a batch that is tried again changes nothing. Runs that no manifest of the last KEEP
    names are removed, so that readers of an older manifest still find theirs. One writer at a time.

    merge, a function from the rows of several runs to one row per key with the same columns, takes the place of the
    newest row; it has to give the same whichever runs are merged first.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, fan: int = 8, merge: Callable[[DataFrame], DataFrame] | None = None):
        if fan < 2:
            raise ValueError("fan must be 2 or more")
        self.spark, self.path, self.key, self.fan, self.merge = spark, path, key, fan, merge

    def _manifests(self) -> list[str]:
        return files.matching(self.spark, f"{self.path}/_manifest/*.json")

    def manifest(self) -> dict:
        """version, high (-1 without a batch), and runs, each with its name, level and batches from low to high."""
        found = self._manifests()
        return json.loads(files.read_text(self.spark, found[-1])) if found else {"version": -1, "high": -1, "runs": []}

    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """Adds a batch, whose keys are distinct, and merges what has become too many; false if it was there already."""
        now = self.manifest()
        if batch_id <= now["high"]:
            return False
        run = self._write(rows, 0, batch_id, batch_id)
        runs, level = [*now["runs"], run], 0
        while len(full := [r for r in runs if r["level"] == level]) >= self.fan:
            merged = self._write(self._newest(full), level + 1, full[0]["low"], full[-1]["high"])
            runs = [r for r in runs if r["level"] != level] + [merged]
            level += 1
        self._publish({"version": now["version"] + 1, "high": batch_id, "runs": runs})
        return True

    def _write(self, rows: DataFrame, level: int, low: int, high: int) -> dict:
        name = f"level-{level}-{low}-{high}-{new_try()}"
        rows.sortWithinPartitions(self.key).write.parquet(f"{self.path}/{name}")
        return {"name": name, "level": level, "low": low, "high": high}

    def _publish(self, manifest: dict) -> None:
        files.write_text(self.spark, f"{self.path}/_manifest/{manifest['version']:012d}.json", json.dumps(manifest))
        kept = self._manifests()[-KEEP:]
        used = {r["name"] for m in kept for r in json.loads(files.read_text(self.spark, m))["runs"]}
        for folder in files.matching(self.spark, f"{self.path}/level-*"):
            if folder.rstrip("/").rsplit("/", 1)[1] not in used:
                files.delete(self.spark, folder)
        for old in self._manifests()[:-KEEP]:
            files.delete(self.spark, old)

    def _newest(self, runs: list[dict]) -> DataFrame:
        """The newest row of each key among runs, of which each has a key once."""
        every = None
        for r in runs:
            part = self.spark.read.parquet(f"{self.path}/{r['name']}").withColumn("__at", F.lit(r["high"]).cast("bigint"))
            every = part if every is None else every.unionByName(part)
        if self.merge is not None:
            return self.merge(every.drop("__at")).select(*[c for c in every.columns if c != "__at"])
        rest = [c for c in every.columns if c not in (self.key, "__at")]
        return every.groupBy(self.key).agg(F.max_by(F.struct(*rest), "__at").alias("x")).select(self.key, "x.*")

    def read(self, schema: str | None = None) -> DataFrame:
        """The newest row of each key; schema is needed where there may be no batch yet."""
        runs = self.manifest()["runs"]
        return self._newest(runs) if runs else self.spark.createDataFrame([], schema)
