"""Ranks against plain Python and the query against its SQL."""

import math
import re
from collections import Counter

import numpy as np

from judgeset.llm import lexical_search as L

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def brute_force(items, docs, k=20):
    words = lambda t: re.findall(L.TERM, (t or "").translate(str.maketrans(UP, LOW)))
    texts = [(i, Counter(words(t))) for i, t in docs]
    texts = [(i, c, c.total()) for i, c in texts if c]
    count, total = len(texts), sum(n for *_, n in texts)
    df = Counter(w for _, c, _ in texts for w in c)
    out = []
    for item, text in items:
        asked, found = Counter(words(text)), []
        for i, c, n in texts:
            m = 75 + 25 * n * count // total
            score = sum(times * math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 12 * m)) for w, times in asked.items() if w in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def generated(seed, n_docs, n_items, words=60):
    rng = np.random.default_rng(seed)
    pool = [*(f"w{i}" for i in range(words)), "É", "éa", "X9", "中文", "İ"]
    text = lambda most: rng.choice([" ", "-", "\n", "_"]).join(pool[int(len(pool) * x**3)] for x in rng.random(int(rng.integers(0, most))))
    docs = [(i, text(50)) for i in range(n_docs)] + [(n_docs + i, "w1 w2 w2 w3") for i in range(40)]
    return [(100 + i, text(12)) for i in range(n_items)], docs


def run(spark, items, docs, **options):
    a = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    b = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    return sorted((tuple(r) for r in L.lexical_search(a, b, **options).collect()), key=str)


def test_generated_with_ties(spark):
    items, docs = generated(1, 300, 25)
    assert run(spark, items, docs) == brute_force(items, docs)


def test_items_in_blocks_and_small_heaps(spark, monkeypatch):
    """Several blocks of items, few cells at once, and heaps that are cut back all the time give the same rows."""
    items, docs = generated(2, 200, 30)
    for name, value in (("POSTINGS", 60), ("CELLS", 64), ("WAITING", 40)):
        monkeypatch.setattr(L, name, value)
    assert run(spark, items, docs, k=3) == brute_force(items, docs, 3)


def test_odd_rows(spark):
    items = [(1, "a b a"), (1, "a b a"), (2, None), (3, ""), (4, "zzz"), (None, "B")]
    docs = [(None, "a"), (7, "A b"), (7, "A b"), (8, None), (9, ""), (10, "-- "), (None, "a"), (11, "x " * 200_000), (12, "c d e"), (13, "c"), (14, "d"), (15, "e")]
    assert run(spark, items, docs) == brute_force(items, docs)
    assert run(spark, items[:0], docs) == run(spark, items, docs[:0]) == []


def test_other_columns_and_names(spark):
    items = spark.createDataFrame([(1, "a b", 5, 6)], "q long, words string, item int, rank int")
    docs = spark.createDataFrame([(3, "b c", 1), (4, "c", 2), (5, "d", 2)], "number long, body string, terms int")
    got = [tuple(r) for r in L.lexical_search(items, docs, item_id="q", item_text="words", doc_id="number", text="body").collect()]
    assert got == brute_force([(1, "a b")], [(3, "b c"), (4, "c"), (5, "d")])


def test_query(against_oracle):
    against_oracle("op12_lexical_search", "/root/testdata/sf0.01")
