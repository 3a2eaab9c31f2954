import re

import numpy as np
import pytest

from judgeset.llm.jaccard_join import near_duplicate_groups, op9_jaccard_join


def _sets(rows):
    out = {}
    for i, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        out[i] = grams
    return out


def brute_force(rows):
    sets = _sets(rows)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_gram = {}
    for i, s in sets.items():
        for g in s:
            by_gram.setdefault(g, []).append(i)
    pairs = {(a, b) for ids in by_gram.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_matches_brute_force_on_documents(spark, small):
    for d in (small, "/root/testdata/sf0.01"):
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op9_jaccard_join(spark, d).collect()}
        assert got == brute_force(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force_on_edits_and_large_groups(spark, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, common = [], " ".join(rng.choice(vocabulary, 30))
    for base in range(40):
        words = list(rng.choice(vocabulary, int(rng.integers(1, 120))))
        for copy in range(int(rng.integers(1, 4)) if base else 60):
            mine = list(words)
            for _ in range(int(rng.integers(0, 3 + len(mine) // 30))):
                mine[int(rng.integers(len(mine)))] = str(rng.choice(vocabulary))
            text = " ".join(mine)
            rows.append((len(rows), (common + " " + text).upper() if base % 3 == 0 else text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_groups(df).collect()}
    assert got == brute_force(rows)


def test_odd_rows(spark):
    long_ = "x y z " * 30_000
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "one two", 1), (5, "ONE\ttwo", 1), (5, "ONE\ttwo", 2), (None, "one two", 3), (None, None, 3), (8, long_, 1), (9, long_, 1), (10, "ünï a b c d", 5)]
    df = spark.createDataFrame([(a, b, c, c) for a, b, c in rows], "doc_id long, text string, n long, key long")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in near_duplicate_groups(df).collect())
    assert got == [(-1, 0, None), (-1, 1, 4), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (8, 3, 8), (9, 3, 8), (10, 1, 10)]
    assert near_duplicate_groups(df.limit(0)).count() == 0


def test_long_runs_in_blocks_match_brute_force(spark, monkeypatch):
    """Hundreds of texts around shared passages, some linked and some not, with blocks of a few members."""
    from judgeset.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(80)]
    rows = []
    for _ in range(300):
        cut = passage[int(rng.integers(0, 8)) : 80 - int(rng.integers(0, 8))]
        own = [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(0, 60)))]
        rows.append((len(rows), " ".join([*own[: len(own) // 2], *cut, *own[len(own) // 2 :]])))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = brute_force(rows)
    assert got == want and len({c for _, c in want.values()}) > 10


def test_shared_passage_makes_no_pairs(spark):
    """2,000 texts, 70 % of each the same passage: none links, and none even becomes a candidate."""
    from judgeset.llm._hashing import shingles
    from judgeset.llm.jaccard_join import CELLS, _runs, signatures

    passage = " ".join(f"p{i}" for i in range(140))
    texts = [f"{passage} " + " ".join(f"w{k}x{i}" for i in range(60)) for k in range(2000)]
    value, begins = shingles([t.encode() for t in texts])
    levels = np.zeros(1 << (CELLS - 4), np.uint64)
    number, count = np.unique(value, return_counts=True)
    for x in (number[count >= 4] & np.uint64((1 << CELLS) - 1)).tolist():
        levels[x >> 4] |= np.uint64(9 << (4 * (x & 15)))
    of, key, rank, before = signatures(value, begins, levels)
    import pandas as pd

    rows = pd.DataFrame({"key": key.view(np.int64), "class": of, "n": np.diff(begins)[of].astype(np.int32), "rank": rank, "before": before}).sort_values(["key", "rank", "class"])
    batches = [rows.iloc[i : i + 1000] for i in range(0, len(rows), 1000)]
    assert sum(map(len, _runs(iter(batches)))) == 0
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near_duplicate_groups(df).filter("component_id = doc_id").count() == 2000


def test_runs_stream_over_batches():
    """Pairs, stars and members do not depend on where batches end."""
    import pandas as pd

    from judgeset.llm.jaccard_join import RUN, _runs

    rng = np.random.default_rng(3)
    keys = np.repeat(np.arange(60), rng.integers(1, 3 * RUN, 60))
    rows = pd.DataFrame({"key": keys, "class": rng.integers(0, 500, len(keys)), "n": rng.integers(90, 110, len(keys)), "rank": rng.integers(0, 10, len(keys)), "before": rng.integers(0, 9, len(keys))}).drop_duplicates(["key", "class"]).sort_values(["key", "rank", "class"])

    def found(size):
        out = pd.concat(_runs(rows.iloc[i : i + size] for i in range(0, len(rows), size)))
        pairs = out[out["key"].isna()]
        return set(zip(pairs["a"], pairs["b"], strict=True)), set(zip(out["key"].dropna(), out["class"].dropna(), strict=True))

    assert all(found(size) == found(10**6) for size in (1, 2, RUN - 1, RUN, RUN + 1, 100))


def test_least_level_that_is_kept():
    from judgeset.llm.jaccard_join import _least

    assert _least({2: 100, 3: 10, 4: 5, 9: 1}, 1000) == 2
    assert _least({2: 100, 3: 10, 4: 5, 9: 1}, 16) == 3
    assert _least({2: 100, 3: 10, 4: 5, 9: 1}, 5) == 9
    assert _least({9: 60}, 5) == 9 and _least({}, 5) == 0


def test_order_with_a_small_array(spark, monkeypatch):
    """2^8 cells for some thousand common shingles: the same links, and no position outside the array is in 2^least sets."""
    from judgeset.llm import jaccard_join
    from judgeset.llm._hashing import shingles
    from judgeset.llm._tables import Scratch

    monkeypatch.setattr(jaccard_join, "CELLS", 8)
    rng = np.random.default_rng(11)
    passages = [[f"p{k}x{i}" for i in range(25)] for k in range(60)]
    chance = 1 / np.arange(1, 61)
    rows = []
    for i in range(300):
        words = [w for k in rng.choice(60, 3, replace=False, p=chance / chance.sum()) for w in passages[k]]
        words += [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(5, 40)))]
        rows += [(3 * i, " ".join(words))]
        if i % 3 == 0:
            words[int(rng.integers(len(words)))] = "edit"
            rows += [(3 * i + 1, " ".join(words))]
    value, begins = shingles([t.encode() for _, t in rows])
    number, docs = np.unique(value, return_counts=True)
    twice = docs > 1
    shared = spark.createDataFrame([(int(a), int(b)) for a, b in zip(number[twice].view(np.int64), docs[twice], strict=True)], "shingle long, docs long")
    levels = jaccard_join._levels(shared, Scratch(spark, "test"))
    logs = np.floor(np.log2(docs[docs >= 4])).astype(int)
    least = jaccard_join._least(dict(zip(*np.unique(logs, return_counts=True), strict=True)), 2**8 // jaccard_join.ROOM)
    assert len(levels) == 16 and least > 2
    of, key, _, _ = jaccard_join.signatures(value, begins, levels)
    outside = jaccard_join.level_of(key, levels) == 0
    _, runs = np.unique(key[outside], return_counts=True)
    assert runs.max() < 2**least
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = brute_force(rows)
    assert got == want and len({c for _, c in want.values()}) < len(rows)
