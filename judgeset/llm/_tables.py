"""Tables written to the cluster's shared folder to cut lineage, and reading of the input tables."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, local mode gets a folder of its own; a cluster, whose
    machines would not see each other's folders, gets an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL[app]


def tidy(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """f, a function of an iterator of batches, with its memory given back when a partition ends: Python workers serve
    later tasks too, and what freed arrays leave in the allocators' pools would add up from stage to stage."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            release_memory()

    return run


def release_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Batches of about this size go to Python workers, however long a row's texts are."""
    usual = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, usual)


class Scratch:
    """Parquet tables of one operator run, each under a name of its own in the shared folder.

    A written table survives the loss of any executor and has a known size, so Spark can decide by
    that size whether a join may broadcast it. drop() removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{operator}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:02d}-{name}"
        with small_batches(self.spark):
            df.write.option("compression", compression).parquet(path)
        return self._kept(path, df.schema)

    def split(self, df: DataFrame, name: str, by: str, kinds: int, compression: str = "zstd") -> list[DataFrame]:
        """Writes one table for each value of by from 0 to kinds - 1, without that column, in one pass over df."""
        self.n += 1
        path = f"{self.root}/{self.n:02d}-{name}"
        with small_batches(self.spark):
            df.write.partitionBy(by).option("compression", compression).parquet(path)
        jvm, rest = self.spark._jvm, df.drop(by).schema
        for k in range(kinds):  # a kind without rows has no folder yet
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={k}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        return [self._kept(f"{path}/{by}={k}", rest) for k in range(kinds)]

    def _kept(self, path: str, schema) -> DataFrame:
        kept = self.spark.read.schema(schema).parquet(path)
        kept._scratch_path = path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in kept:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The given names, with underscores in front of those that df has already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
