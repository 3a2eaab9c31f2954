"""Bounded samples of labelled documents for the classifiers, and hashed word features."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of all ids, never trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, label: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most per_class labelled documents of each class, those with the smallest hash of their id, and the classes'
    sizes. Rows without id or label and held-out ids are left out. Only the sample's ids reach the driver."""
    known = labels.select("doc_id", label.cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out())
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picked = None
    for y in sorted(sizes):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        picked = known
    rows = [(r["doc_id"], r["y"]) for r in picked.collect()]  # per_class rows of each class at most
    ids = documents.sparkSession.createDataFrame(rows, "doc_id long, y int").groupBy("doc_id").agg(F.min("y").alias("y"))
    return documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), sizes


class WordWeights(dict):
    """word -> number, filled as words are seen up to a bound; compute() gives the number of a new word."""

    def __init__(self, compute, most: int = 200_000):
        self.compute, self.most = compute, most

    def __missing__(self, word: str):
        value = self.compute(word)
        if len(self) < self.most:
            self[word] = value
        return value


def bucket(word: str, bits: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1)
