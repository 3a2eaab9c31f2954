import hashlib
from collections import Counter

import numpy as np
import pytest

from judgeset.llm import suffix_dedup
from judgeset.llm.suffix_dedup import LENGTH, op5_suffix_dedup, remove_repeats


def brute_force(rows):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + LENGTH] for i in range(len(b) - LENGTH + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - LENGTH + 1):
            if seen[b[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = True
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


def query(df):
    import pyspark.sql.functions as F

    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    done = remove_repeats(df).withColumn("n_removed", removed)
    return done.select("doc_id", (F.octet_length("kept") + F.col("n_removed")).alias("n_bytes"), "n_removed", F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def test_documents(spark):
    for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
        assert got(op5_suffix_dedup(spark, d)) == brute_force(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(spark, seed):
    rng = np.random.default_rng(seed)
    letters = list("abcdefghij é\n")
    word = lambda n: "".join(rng.choice(letters, n))
    passages = [word(int(n)) for n in rng.integers(150, 500, 12)]
    rows = []
    for i in range(120):
        text = word(int(rng.integers(0, 900)))
        for _ in range(int(rng.integers(0, 3))):
            p = passages[int(rng.integers(12))]
            cut = int(rng.integers(0, len(p) // 2))
            text += p[cut : cut + int(rng.integers(100, 500))] + word(int(rng.integers(0, 60)))
        rows.append((i, text))
    rows += [(900, rows[3][1]), (901, rows[3][1][:-1]), (902, "a" * 700), (903, "ab" * 300), (904, "a" * 199)]
    assert got(query(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute_force(rows)


def test_odd_rows(spark):
    long_ = "".join(np.random.default_rng(0).choice(list("abcdefgh "), 30_000))
    rows = [(1, None), (2, ""), (3, long_), (3, long_), (None, long_[:250]), (5, long_[:199]), (6, long_ * 3)]
    df = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, h long, size int")
    assert got(query(df)) == brute_force(rows)
    assert query(df.limit(0)).count() == 0


def test_parts_of_a_long_text_do_not_matter():
    text = "".join(np.random.default_rng(1).choice(list("abcdefgh "), 5_000)).encode()
    before = suffix_dedup.PART
    try:
        suffix_dedup.PART = 700
        starts = [s for who, at, pieces in suffix_dedup._parts([text, b"x" * 10, text]) for w, a, p in zip(who, at, pieces) if w == 2 for s in range(a, a + len(p) - LENGTH + 1)]
    finally:
        suffix_dedup.PART = before
    assert starts == list(range(len(text) - LENGTH + 1))


def test_crowded_triggers(spark, monkeypatch):
    """A trigger with more than two phrases counts as crowded, so most shared strings are told apart one by one."""
    monkeypatch.setattr(suffix_dedup, "MANY", 2)
    rng = np.random.default_rng(6)
    word = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passages = [word(260) for _ in range(3)]
    rows = [(i, word(int(rng.integers(0, 300))) + passages[i % 3][int(rng.integers(0, 50)) :] + word(int(rng.integers(0, 300)))) for i in range(60)]
    rows += [(100, rows[0][1]), (101, "ab" * 300)]
    got_rows = got(query(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert got_rows == brute_force(rows) and sum(r[2] > 0 for r in got_rows) > 50


def test_text_above_a_part(spark):
    """A text of more than PART bytes with a repeat that crosses the parts' border, and one text with a piece of it."""
    n = suffix_dedup.PART
    letters = np.random.default_rng(7).integers(97, 123, n + 5_000).astype(np.uint8).tobytes().decode()
    piece = letters[n - 150 : n + 150]
    rows = [(1, letters), (2, piece), (3, letters[:120])]
    want = {1: (len(letters), 300, 1), 2: (300, 300, 1), 3: (120, 0, 0)}
    assert {r[0]: r[1:4] for r in got(query(spark.createDataFrame(rows, "doc_id long, text string")))} == want
