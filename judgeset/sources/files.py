"""Small files and folders in any file system that Spark reaches, and new paths in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _path(spark, path)
    return fs.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    fs, found = _path(spark, path)
    fs.delete(found, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order; none if nothing does."""
    fs, found = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(found) or []))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that appears whole under its name, which must be new, or not at all."""
    fs, found = _path(spark, path)
    fs.mkdirs(found.getParent())
    _, part = _path(spark, f"{found.getParent().toString()}/_{uuid.uuid4().hex}.tmp")
    out = fs.create(part, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(part, found):
        fs.delete(part, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, found = _path(spark, path)
    stream = fs.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share; in local mode one of its own where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
