from collections import defaultdict

import numpy as np

from judgeset.llm.mixing import GRID, Target, mix_sources, temperature


def test_query(against_oracle):
    against_oracle("op7_mixing", "/root/testdata/sf0.01")


def table(spark, sizes):
    rows = [(i * 1000 + k, s, "w " * (1 + k % 7)) for i, (s, n) in enumerate(sizes.items()) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4), rows


def totals(rows):
    out = defaultdict(int)
    for _, s, t in rows:
        out[s] += len(t.split())
    return out


def test_exponent(spark):
    shares = spark.createDataFrame([("a", 8000), ("b", 1000), ("c", 1000)], "k string, tokens long")
    t = np.array([8000.0, 1000, 1000])

    def entropy(a):
        w = t**a / (t**a).sum()
        return -(w * np.log(w)).sum()

    a = temperature(shares, Target(entropy=0.9))
    assert entropy(a) <= 0.9 < entropy(a - 1 / GRID)
    a = temperature(shares, Target(max_repeats=2.0))
    assert 8 ** (1 - a) <= 2 + 1e-9 < 8 ** (1 - a + 1 / GRID)
    assert temperature(shares, Target(entropy=99.0)) == 0.0
    assert temperature(shares, Target(max_repeats=1.0)) == 1.0


def test_budget_is_met_in_whole_documents(spark):
    df, rows = table(spark, {"big": 900, "mid": 300, None: 90})
    t = totals(rows)
    budget = 3000
    out = mix_sources(df, target=Target(entropy=1.0, budget=budget), seed=3)
    a = temperature(spark.createDataFrame([(str(k), v) for k, v in t.items()], "k string, tokens long"), Target(entropy=1.0))
    z = sum(v**a for v in t.values())
    got = defaultdict(int)
    for r in out.collect():
        got[r["source"]] += r["copies"] * r["tokens"]
    for s, v in t.items():
        want = budget * v**a / z
        assert want - 8 <= got[s] <= want + 1e-6, s  # short of the share by less than one document


def test_default_loses_nothing(spark):
    df, rows = table(spark, {"big": 400, "small": 20})
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(df).collect()}
    assert len(copies) == len(rows) and min(copies.values()) >= 1 and max(copies.values()) == 2


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, 1, 2), (1, None, None, 1, 2), (None, "s", "", 1, 2), (4, "t", "a b", 1, 2), (4, "t", "a b", 1, 2), (5, "t", "x " * 50_000, 1, 2)], "doc_id long, source string, text string, copies int, k int")
    out = mix_sources(df)
    assert out.columns.count("copies") == 1 and out.count() == 6
    assert all(r["copies"] >= 1 for r in out.collect())
    assert mix_sources(df.limit(0)).count() == 0


def test_clashing_names(spark):
    names = ["k", "_k", "h", "whole", "blocks", "place", "block", "last", "__k", "tokens", "copies"]
    df = spark.createDataFrame([(i, "s", f"a {i}", *range(len(names))) for i in range(30)], "doc_id long, source string, text string, " + ", ".join(f"`{n}` int" for n in names))
    out = mix_sources(df)
    assert out.columns == [c for c in df.columns if c not in ("tokens", "copies")] + ["tokens", "copies"]
    assert {tuple(r[n] for n in names[:9]) for r in out.collect()} == {tuple(range(9))}
