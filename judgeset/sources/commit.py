"""Batches whose tables become visible together.

Each try of a batch writes its tables to folders of its own, path/batch_id=N/try=T. A small file in the manifest folder,
written last, names the try that counts; readers follow these files. So a try that broke off is invisible, an empty try
shows no rows of an earlier one, and a batch that is committed again replaces itself in all of its tables at once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, _parse_datatype_string

from judgeset import schemas
from judgeset.sources import files
from judgeset.sources.files import exists

MANIFEST = "try string, turn bigint, batch_id bigint"


def manifest_of(ledger_path: str) -> str:
    """Where commit_batch keeps the manifest: beside the operations, under a name that table readers pass over."""
    return f"{ledger_path}/_manifest"


def new_try() -> str:
    return f"t{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str, batch_id: int, attempt: str) -> None:
    """Writes one table of a try; nobody sees it before the try is sealed."""
    df.drop("batch_id", "try").write.parquet(f"{path}/batch_id={batch_id}/try={attempt}")


def seal(spark: SparkSession, manifest: str, batch_id: int, attempt: str) -> None:
    """Makes a try the one that counts for its batch, in place of any sealed before."""
    turn = len(files.matching(spark, f"{manifest}/batch_id={batch_id}/*.json"))
    files.write_text(spark, f"{manifest}/batch_id={batch_id}/{turn:06d}.json", json.dumps({"try": attempt, "turn": turn}))


def sealed(spark: SparkSession, manifest: str) -> DataFrame:
    """(batch_id, try) of each committed batch."""
    if not exists(spark, manifest):
        return spark.createDataFrame([], "batch_id bigint, try string")
    return spark.read.schema(MANIFEST).json(manifest).groupBy("batch_id").agg(F.max_by("try", "turn").alias("try"))


def commit_tables(tables: dict[str, DataFrame], manifest: str, batch_id: int) -> str:
    """Writes every table (path: rows) of a batch and makes them visible together; returns the name of the try. If
    anything fails, what the try wrote is taken away again."""
    spark, attempt = next(iter(tables.values())).sparkSession, new_try()
    try:
        for path, df in tables.items():
            stage(df, path, batch_id, attempt)
        seal(spark, manifest, batch_id, attempt)
    except BaseException:
        abort(spark, list(tables), batch_id, attempt)
        raise
    return attempt


def abort(spark: SparkSession, paths: list[str], batch_id: int, attempt: str) -> None:
    """Removes what a try wrote."""
    for path in paths:
        files.delete(spark, f"{path}/batch_id={batch_id}/try={attempt}")


def recover(spark: SparkSession, paths: list[str], manifest: str) -> int:
    """Removes the folders of tries that were never sealed or have been replaced, and returns how many there were. To be
    run while nothing writes to these tables, as at the start of a run; what is listed is one name a batch and try."""
    counting = {(r["batch_id"], r["try"]) for r in sealed(spark, manifest).collect()}
    gone = 0
    for path in paths:
        for folder in files.matching(spark, f"{path}/batch_id=*/try=*"):
            batch, attempt = (part.split("=", 1)[1] for part in folder.rstrip("/").split("/")[-2:])
            if (int(batch), attempt) not in counting:
                files.delete(spark, folder)
                gone += 1
    return gone


def read_committed(spark: SparkSession, path: str, manifest: str, schema: StructType | str | None = None) -> DataFrame:
    """Rows of the committed batches of one table, with batch_id. schema (of the rows) is needed where all may be empty."""
    if schema is None:
        rows = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    else:
        fields = (_parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
        own = [f for f in fields if f.name not in ("batch_id", "try")]
        whole = StructType([*own, StructField("batch_id", LongType()), StructField("try", StringType())])
        rows = spark.read.schema(whole).parquet(path) if exists(spark, path) else spark.createDataFrame([], whole)
    return rows.join(sealed(spark, manifest), ["batch_id", "try"], "left_semi").drop("try")


def commit_batch(rows: DataFrame, ops: DataFrame, out_path: str, ledger_path: str, batch_id: int) -> None:
    """Commits a batch's rows together with its operations; see commit_tables."""
    commit_tables({out_path: rows, ledger_path: ops}, manifest_of(ledger_path), batch_id)


def read_ops(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Operations of the committed batches."""
    return read_committed(spark, ledger_path, manifest_of(ledger_path), schemas.OPS)


def committed(spark: SparkSession, out_path: str, ledger_path: str, schema: StructType | None = None) -> DataFrame:
    """Output rows of the committed batches. schema (of the rows) is needed where all may be empty."""
    return read_committed(spark, out_path, manifest_of(ledger_path), schema)
