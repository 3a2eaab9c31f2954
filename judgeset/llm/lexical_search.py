"""Reversed search: an inverted index of the items is broadcast, and every document's term counts stream through it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch, table, tidy

#: Postings of the items in one broadcast index. More items go in several blocks, each with a pass over the documents.
POSTINGS = 1_000_000
#: Scores in work at once, and candidates that wait before heaps are brought back to size.
CELLS, WAITING = 1 << 20, 1 << 17
#: Heaps of one item are merged in so many groups first, so that no task gets those of all partitions.
GROUPS = 32

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of a UTF-8 text, byte by byte: A to Z become lower case, other ASCII than letters and digits blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def terms(text: Column) -> Column:
    """Terms of a text in order, with repeats; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of (doc_id, text binary): its number of terms, and numbers and counts of those in the
    vocabulary. Rows without any term are left out."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            at, sizes, found, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column(1)):
                words = text.as_py().translate(_BYTES).split()
                if not words:
                    continue
                times = Counter(words)
                mine = number.keys() & times.keys()
                at.append(i)
                sizes.append(len(words))
                found.extend(number[w] for w in mine)
                counts.extend(times[w] for w in mine)
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((found, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, terms array<int>, tfs array<long>")


class Index:
    """Items by term, of one block: postings of term t are those from first[t] to first[t + 1]."""

    def __init__(self, term: np.ndarray, item: np.ndarray, times: np.ndarray, weight: np.ndarray, n_items: int):
        order = np.argsort(term, kind="stable")
        self.item, self.times, self.weight, self.n_items = item[order], times[order], weight, n_items
        self.first = np.searchsorted(term[order], np.arange(len(weight) + 1))


class Heaps:
    """The k best (score, id) of each item: higher scores first, then smaller ids, then rows without an id."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.zeros(n_items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        self.parts.append((item, score, doc, null))
        self.waiting += len(item)
        if self.waiting > WAITING:
            self.best()

    def best(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, bool))
        item, score, doc, null = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((doc, null, -score, item))
        first = np.searchsorted(item[order], item[order], side="left")
        order = order[np.arange(len(order)) - first < self.k]
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        count = np.bincount(item, minlength=len(self.floor))
        last = np.cumsum(count) - 1
        full = count == self.k
        self.floor[full] = score[last[full]]
        self.parts, self.waiting = [(item, score, doc, null)], 0
        return self.parts[0]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of count[0] numbers, and so on."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def score_batch(index: Index, heaps: Heaps, doc: np.ndarray, null: np.ndarray, m: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
    """Scores documents, whose terms are those between ends, against every item that shares one, in 64-bit integers."""
    size = np.diff(ends)
    value = index.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, size)))
    count = index.first[term + 1] - index.first[term]
    work = np.concatenate([[0], np.cumsum(count)])[ends]  # postings up to each document
    step, start = max(1, CELLS // max(1, index.n_items)), 0
    while start < len(doc):
        end = max(start + 1, min(start + step, int(np.searchsorted(work, work[start] + CELLS, side="right")) - 1))
        a, b = ends[start], ends[end]
        posting = _ranges(index.first[term[a:b]], count[a:b])
        row = np.repeat(np.repeat(np.arange(end - start), size[start:end]), count[a:b])
        scores = np.zeros((end - start) * index.n_items, np.int64)
        np.add.at(scores, row * index.n_items + index.item[posting], np.repeat(value[a:b], count[a:b]) * index.times[posting])
        scores = scores.reshape(end - start, index.n_items)
        d, i = np.nonzero((scores > 0) & (scores >= heaps.floor))
        if len(d):
            heaps.offer(i, scores[d, i], doc[start + d], null[start + d])
        start = end


def score_documents(counts: DataFrame, index: Index, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each item among each task's rows of counts (with its m)."""
    sent = counts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(sent.value.n_items, k)
        for batch in batches:
            ids, m, found, tfs = (batch.column(i) for i in range(4))
            ends = np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            numbers = [x.to_numpy(zero_copy_only=False) for x in (ids.fill_null(0), m, found.flatten(), tfs.flatten())]
            score_batch(sent.value, heaps, numbers[0], null, numbers[1], ends, *numbers[2:])
        item, score, doc, null = heaps.best()
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64(), mask=null), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return counts.select("doc_id", "m", "terms", "tfs").mapInArrow(tidy(run), "item long, doc_id long, score long")


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """The k best of each item over all tasks, with their ranks; groups of an item's rows are merged first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = W.partitionBy("item", F.pmod(F.xxhash64("doc_id", "score"), F.lit(GROUPS))).orderBy(*order)
    some = heaps.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def lexical_search(items: DataFrame, docs: DataFrame, k: int = 20, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents that match each item best.

    Terms are runs of ASCII letters and digits and all other characters beyond ASCII; A to Z count as lower case. N is
    the number of documents with a term, L that of all their terms, n one document's, df a term's documents, tf its
    occurrences in a document. A term weighs w = floor(1000 ln((2N + 2) / (2df + 1))); with m = 75 + 25nN div L a
    document scores the sum of w (10^9 tf div (1000tf + 12m)) over an item's terms, repeats included, in 64-bit integers.
    Documents with score 0 are left out. Equal scores stand by ascending doc_id (long), those without an id last.

    Null and empty texts have no terms and match nothing. Every row of items is an item, every row of docs a document,
    so repeated rows have results of their own. Only the named columns are read. Empty tables give no rows.

    Documents are never shuffled: one pass writes their counts of the items' terms, another sums them up, a third
    scores them. A task keeps k rows an item, and those are all that is shuffled. The index is broadcast in blocks of
    items with about POSTINGS (term, item) pairs, by a hash of the item; each block passes over the documents once.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "search")
    numbered = scratch.keep(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), terms(F.col(item_text)).alias("terms")), "items")
    postings = numbered.select("item", F.explode("terms").alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))
    postings = scratch.keep(postings, "postings")
    blocks = max(1, -(-postings.count() // POSTINGS))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    found = None
    for block in range(blocks):
        mine = postings.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toPandas()
        vocabulary, term = np.unique(mine["term"].to_numpy(dtype=object), return_inverse=True) if len(mine) else (np.zeros(0, object), np.zeros(0, np.int64))
        item, at = np.unique(mine["item"].to_numpy(dtype=np.int64), return_inverse=True)
        counts = scratch.keep(count_terms(texts, {w.encode(): i for i, w in enumerate(vocabulary)}), "counts")
        totals = counts.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()
        df = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        ratio = F.lit(2 * totals["docs"] + 2).cast("double") / (2 * F.col("df") + 1)
        weight = np.zeros(len(vocabulary), np.int64)
        for row in df.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w")).collect():  # one number a term of the block
            weight[row["term"]] = row["w"]
        index = Index(term, at, mine["times"].to_numpy(dtype=np.int64), weight, len(item))
        m = F.expr(f"75L + (25L * n * {totals['docs']}L) div {max(1, totals['all'])}L").alias("m")
        best = _merged(score_documents(counts.select("doc_id", m, "terms", "tfs"), index, k), k)
        numbers = spark.createDataFrame([(i, int(x)) for i, x in enumerate(item)], "item long, number long")
        best = scratch.keep(best.join(numbers, "item").select(F.col("number").alias("item"), "rank", "doc_id", "score"), "best")
        scratch.drop(counts)
        found = best if found is None else found.unionByName(best)
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for every benchmark item."""
    return lexical_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def _sql(k: int = 20) -> str:
    split = f"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term"
    return f"""
WITH words AS (SELECT r, doc_id, {split} FROM (SELECT row_number() OVER () AS r, * FROM documents)),
tf AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY r, term),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS every FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
asked AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, {split} FROM (SELECT row_number() OVER () AS i, * FROM benchmark)) GROUP BY i, item_id, term),
scored AS (
  SELECT i, item_id, doc_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // every)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (r), totals GROUP BY i, item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= {k}
"""


OP12_SQL = _sql()
