import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from judgeset.llm import packing as P


def check_plan(histogram, capacity):
    bins, rest = P.rounded(histogram, P.configuration_lp(histogram, capacity, rounds=12, columns=8).columns)
    bins = P.best_fit_decreasing(rest, capacity, bins)
    held = Counter()
    for times, what in bins:
        assert sum(s * n for s, n in what) <= capacity
        for s, n in what:
            held[s] += times * n
    assert held == Counter({k: v for k, v in histogram.items() if v})
    return sum(t for t, _ in bins)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plans_place_every_piece_once(histogram):
    check_plan(histogram, 64)


def test_knapsack_is_optimal():
    value = np.array([0, 1.0, 5, 8, 9, 10, 17, 17, 20])
    best, last = P.knapsack(value)
    want = [0.0]
    for c in range(1, 9):
        want.append(max(value[s] + want[c - s] for s in range(1, c + 1)))
    assert np.allclose(best, want)
    assert sum(value[s] for s in P._taken(last, 8)) == want[8]


HARD = {
    "a": ({41: 1000, 35: 1000, 26: 1000, 24: 2000, 15: 1500}, 100),
    "b": ({44: 600, 33: 600, 23: 1200, 61: 300, 39: 300, 27: 900}, 100),
    "c": ({51: 500, 27: 500, 26: 500, 23: 1000, 25: 1000}, 100),
}


@pytest.mark.parametrize("name", HARD)
def test_the_lp_is_solved(name):
    """Covers every demand, within 2 % of a lower bound, with fewer bins than best-fit decreasing alone."""
    histogram, capacity = HARD[name]
    lp = P.configuration_lp(histogram, capacity)
    covered = Counter(lp.rest)
    for config, times in lp.columns.items():
        assert times > 0 and sum(s * k for s, k in config) <= capacity
        for s, k in config:
            covered[s] += times * k
    assert all(abs(covered[s] - n) < 1e-6 * n for s, n in histogram.items())
    bins, rest = P.rounded(histogram, lp.columns)
    total = sum(t for t, _ in P.best_fit_decreasing(rest, capacity, bins))
    alone = sum(t for t, _ in P.best_fit_decreasing(histogram, capacity))
    print(f"{name}: primal {lp.primal:.1f}, dual {lp.dual:.1f}, bins {total}, best-fit decreasing alone {alone}")
    assert sum(s * n for s, n in histogram.items()) / capacity * (1 - 1e-5) <= lp.dual <= lp.primal <= 1.02 * lp.dual
    assert lp.dual <= total <= lp.primal + len(lp.columns) and total < alone


@pytest.mark.parametrize("pieces", [5_000, 500_000])
def test_the_lp_packs_most_tokens(pieces):
    """Many lengths with few pieces each: what rounding leaves is solved again, best-fit decreasing packs the least part."""
    drawn = np.random.default_rng(1).lognormal(6, 1, pieces)
    histogram = Counter(np.clip(drawn, 1, 2048).astype(int).tolist())
    bins, rest = P.configured(histogram, 2048)
    tokens = lambda h: sum(s * n for s, n in h.items())
    held = Counter(rest)
    for times, what in bins:
        for s, n in what:
            held[s] += times * n
    assert held == histogram
    total = sum(t for t, _ in P.best_fit_decreasing(rest, 2048, bins))
    print(f"{len(histogram)} lengths: {tokens(rest) / tokens(histogram):.2f} left, {total} bins")
    assert tokens(rest) < 0.3 * tokens(histogram) and total <= 1.005 * tokens(histogram) / 2048 + 1


def test_perfect_packing_is_found():
    assert check_plan({60: 100, 40: 100, 50: 100}, 100) == 150


def test_words_encode_like_whole_texts(spark):
    path = P.default_tokenizer()
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", "  ", "a\x1cb it's I'LL", "<|endoftext|> x<|startoftext|>", "É É İx", "ΑΣ    x", "​ a\xa0b", "12²½ 中文 \U0001f600!", "\x00\x7f"]
    tokenizer = P._tokenizer(path)
    for t, got in zip(texts, P.encode_words(texts, path)):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def verify(spark, rows, capacity=4096):
    path = P.default_tokenizer()
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, length int").repartition(3)
    got = P.pack_documents(df, path, capacity=capacity).collect()
    want = []
    for i, t in rows:
        ids = P._tokenizer(path).encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want.append((i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r["length"] for r in got) // capacity) if got else 0


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    n, bound = verify(spark, rows)
    assert n <= bound + 2


@pytest.mark.parametrize("capacity", [16, 64])
def test_small_capacity_and_odd_rows(spark, capacity):
    rows = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "x y"), (7, "word " * 500)] + [(100 + i, "hi there") for i in range(300)]
    verify(spark, rows, capacity)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack_documents(empty, P.default_tokenizer()).count() == 0
