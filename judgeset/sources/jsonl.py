"""JSON-lines readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset import schemas


_BLANK = "(?U)^\\s*\\z"
_SHOWN = 200


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the problem they hold (p) and the reason why they hold none (reason; null for problems and blank lines)."""
    text = spark.read.option("lineSep", "\n").text(path)
    parsed = F.from_json("value", f"{schemas.PROBLEMS}, _malformed string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    p = F.col("p")
    reason = F.when(F.col("value").rlike(_BLANK), None).when(p.isNull() | p["_malformed"].isNotNull(), "malformed").when(p["id"].isNull(), "no id").when(p["input"].isNull(), "no input")
    return text.withColumn("p", parsed).withColumn("reason", reason)


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, reason, text) of the lines that hold no problem: malformed, no id, or no input; line counts from 1,
    blank lines too, and text is cut to 200 code points.

    One pass over the text: each split of a file counts its lines and keeps the place of its bad ones, and the counts of
    the splits before it, in the order of the file, are added. Only a row a split, with its bad lines, is shuffled.
    """
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    place = F.monotonically_increasing_id()  # rows of a split follow each other in one task
    rows = _lines(spark, path).select(split.alias("s"), place.alias("at"), "reason", F.left("value", F.lit(_SHOWN)).alias("text"))
    bad = F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("at", "reason", "text")))
    splits = rows.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), bad.alias("bad"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = splits.select("s.*", "n", "first", "bad").withColumn("before", before)
    found = placed.select("file", "first", "before", F.explode("bad").alias("b"))
    return found.select("file", (F.col("before") + F.col("b.at") - F.col("first") + 1).alias("line"), "b.reason", "b.text")


def read_problems(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(problems, malformed lines) of JSON lines: what load_problems reads, and what would make it fail."""
    good = _lines(spark, path).filter(F.col("p").isNotNull() & F.col("reason").isNull() & ~F.col("value").rlike(_BLANK))
    return good.select("p.id", "p.input", "p.metadata"), malformed_lines(spark, path)


def load_problems(spark: SparkSession, path: str) -> DataFrame:
    """Problems from JSON lines. Blank lines are skipped, unknown keys ignored, metadata kept as JSON text.

    A malformed line, or one without id or input, fails the load with its file and line, after one pass over all lines.
    A number as id is taken as its text.
    """
    good, bad = read_problems(spark, path)
    worst = bad.orderBy("file", "line").first()
    if worst is not None:
        raise ValueError(f"{worst['file']}, line {worst['line']}: {worst['reason']}: {worst['text']}")
    return good


def as_json(df: DataFrame) -> DataFrame:
    """One column value: each row as JSON in the order of its columns, without nulls; metadata as the JSON it holds."""
    if "metadata" in df.columns:
        parsed = F.try_parse_json("metadata")
        df = df.withColumn("metadata", F.when(~F.is_variant_null(parsed), parsed))
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line in the order of df's columns; nulls are left out. As many files as df has partitions."""
    as_json(df).write.mode(mode).text(path)


def read_sft(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SFT_SAMPLES).json(path)


def read_dpo(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DPO_PAIRS).json(path)
