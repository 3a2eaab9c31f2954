"""Variants against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np

from judgeset.llm import spelling as S

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UP, LOW))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(words):
    """Pairs by words with one place left out: replaced at the place, or deleted there."""
    by, out = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            by.setdefault((w[:i] + w[i + 1 :], i), set()).add(w)
    for (short, _), group in by.items():
        for w in group | ({short} & words.keys()):
            out[w] |= group - {w} if w != short else group
            if short in words and w != short:
                out[w].add(short)
    return out


def brute_force(docs):
    n = words_of(docs)
    around = near(n)
    form = {}
    for w in n:
        best = min(around[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(around[w]), n[form[w]] if form[w] else None) for w in n)


def rows(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def generated(seed, texts=400):
    """Few letters, so that edits meet, repeat and chain; counts that spread over orders of magnitude."""
    rng = np.random.default_rng(seed)
    seeds = ["".join(rng.choice(list("abé"), int(rng.integers(4, 9)))) for _ in range(12)]
    pool = set(seeds)
    for w in list(pool) * 12:
        i, c = int(rng.integers(0, len(w) + 1)), str(rng.choice(list("abéÿz")))
        pool |= {w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]}
    pool = sorted(pool)
    return [(i, " ".join(pool[int(len(pool) * x**3)].upper() if x < 0.1 else pool[int(len(pool) * x**3)] for x in rng.random(60))) for i in range(texts)]


def test_generated(spark):
    docs = generated(1)
    got = rows(S.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)))
    want = brute_force(docs)
    assert got == want
    assert any(f is not None and r != f for _, f, r, *_ in want) and max(x[4] for x in want) > 8


def test_long_words(spark, monkeypatch):
    """Words around and beyond the depth of the trie."""
    monkeypatch.setattr(S, "DEEPEST", 6)
    docs = generated(2, 200)
    docs += [(1000 + i, " ".join(["q" * 60, "q" * 61, "q" * 59 + "r", "x" + "q" * 58 + "r", "ab" * 5000, "ab" * 4999 + "a"])) for i in range(4)]
    got = rows(S.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)))
    assert got == brute_force(docs)


def test_odd_rows(spark):
    docs = [(None, "house"), (1, "house hause"), (1, "house hause"), (1, "House-HAUSE"), (2, None), (3, ""), (4, "haus haus haus haus ×÷÷×÷ d’accord " * 3), (5, "ſtraße İstanbul Kelvin")]
    df = spark.createDataFrame([(*d, "w", 1, 2) for d in docs], "doc_id long, text string, word string, n int, node int")
    assert rows(S.spelling_groups(df)) == brute_force(docs)
    assert S.spelling_groups(df.limit(0)).count() == 0


def test_query_on_documents(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert rows(S.op13_spelling_variants(spark, small)) == brute_force(docs)
