"""A corpus pipeline of five stages over documents: toxicity, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns
of documents; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm import toxicity
from judgeset.llm._tables import BATCH_BYTES, Scratch, table
from judgeset.llm.jaccard_join import first_of_near_duplicates
from judgeset.llm.line_dedup import drop_boilerplate_lines
from judgeset.llm.mixing import Target, mix_sources
from judgeset.llm.packing import default_tokenizer, pack_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A line on more than this share of a source's documents is boilerplate: a template line stands on a tenth of them or
#: so, some more and some less, while a phrase that merely recurs stays under a twentieth. The cut lies between the two.
LINE_RATIO = 1 / 15
#: And on so many at least, so that two copies of one document in a small source keep their lines.
LINE_DOCUMENTS = 5
#: No source is repeated more often than this to get nearer to equal weights.
MAX_REPEATS = 1.5


def _small_batches(spark: SparkSession) -> None:
    """A session setting of the pipeline: Arrow batches are bounded in bytes, not only in rows, as texts may be long."""
    spark.conf.set(BATCH_BYTES, "4m")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose noisy-or of sentence scores is 0.5 or more."""
    _small_batches(spark)
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, weights).select(*COLUMNS)


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that too many documents of a source share; every document stays."""
    cleaned = drop_boilerplate_lines(docs, host="source", max_ratio=LINE_RATIO, min_pages=LINE_DOCUMENTS)
    return cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, that with the smallest id; rows without id and repeated ids too."""
    return first_of_near_duplicates(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources; every document occurs at least once."""
    mixed = mix_sources(docs, target=Target(max_repeats=MAX_REPEATS))
    return mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece (doc_id, piece, start, length, ids_crc32, sequence_id, offset); every document is packed,
    each copy of a repeated one too, and null and empty texts are one token."""
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_boilerplate),
    ("jaccard_join", remove_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: The first stage's model has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's rows are written to the shared folder and read again by the next one."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
