import re
from collections import Counter, defaultdict
from statistics import NormalDist

import numpy as np

from judgeset.llm import quality_rules as Q


def statistics(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            inside |= set(range(i, i + 5))
    lines, dup, known = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)], 0, set()
    for x in lines:
        dup += x in known
        known.add(x)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside), len(lines)


def test_statistics_match_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, " \n\t\x0b"), (-4, "a b c d e a b c d e a b c d e"), (-5, "é 😀 <x> #\n\n#\n#"), (-6, "w " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["n_lines"]) for r in Q.text_statistics(df).collect()}
    assert got == {i: statistics(t) for i, t in rows}


def vectors(stats):
    n, chars, symbols, dup, rep, lines = map(float, stats)
    return [np.log1p(n), np.log((chars + 1) / (n + 1)), np.log(1e-3 + symbols / (chars + 1)), np.sqrt(rep / max(n, 1)), np.log(5e-2 + dup / max(lines, 1))]


def brute_force(x, support=0.75, steps=4):
    """Concentration steps on one group, in numpy."""
    ridge = np.diag(np.square(Q.FLOORS))
    lower = lambda v, q: np.sort(v)[max(int(np.ceil(q * len(v))) - 1, 0)]
    m = np.array([lower(c, 0.5) for c in x.T])
    mad = np.array([lower(np.abs(c - a), 0.5) for c, a in zip(x.T, m)]) * 1.4826
    s = mad + np.array(Q.FLOORS)
    z = (x - m) / s
    signs = (z[:, :, None] * z[:, None, :] / np.maximum((z * z).sum(1), 1e-12)[:, None, None]).mean(0)
    best = None
    for c in (np.diag(mad**2), Q.P * signs * np.outer(s, s)):
        mean, cov = m, c
        for _ in range(steps):
            inv = np.linalg.inv(cov + ridge)
            d = np.einsum("ni,ij,nj->n", x - mean, inv, x - mean)
            near = x[d <= lower(d, support) * (1 + 1e-12)]
            mean, cov = near.mean(0), np.cov(near.T, bias=True).reshape(Q.P, Q.P)
        det = np.linalg.slogdet(cov + ridge)[1]
        if best is None or det < best[0]:
            best = (det, mean, np.linalg.inv(cov + ridge))
    d = np.einsum("ni,ij,nj->n", x - best[1], best[2], x - best[1])
    d = d * Q.CHI2_MEDIAN / max(lower(d, 0.5), Q.CHI2_MEDIAN / 4)
    a, b = np.cbrt(lower(d, 0.5)), np.cbrt(lower(d, 0.75))
    return d, max(Q.chi2_cutoff(1e-3), (a + NormalDist().inv_cdf(1 - 1e-3) / NormalDist().inv_cdf(0.75) * (b - a)) ** 3)


def test_distances_match_brute_force(spark):
    """A large group, a group of odd texts, and the groups of the table, a few rows each: all have their own estimate."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"], "l", "s") for r in docs.collect()]
    rows += [(10_000 + i, "nonsense " * 12 if i % 2 else "one two three " + "x" * i + " four five six seven eight nine ten", None, "small") for i in range(60)]
    rows += [(20_000 + r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    rows += [(40_000, "a group of one row that has at least ten words in it", "xx", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in Q.mcd_outliers(df).collect()}
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t, a, b in rows:
        if not got[i]["base_failed"]:
            groups[a, b].append((i, t))
    assert len(groups) > 60 and min(map(len, groups.values())) < 5
    for members in groups.values():
        want, limit = brute_force(np.array([vectors(statistics(t)) for _, t in members]))
        have = np.array([got[i]["distance"] for i, _ in members])
        assert np.allclose(have, want, rtol=0.02, atol=0.05)
        assert np.allclose([got[i]["limit"] for i, _ in members], limit, rtol=0.05)
    assert all(r["kept"] == (not r["base_failed"] and r["distance"] <= r["limit"]) for r in got.values())
    assert got[40_000]["distance"] == 0 and got[40_000]["kept"]


def test_the_limit_spares_ordinary_rows(spark):
    """Labels only judge the result: the limit is drawn from the distances alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [r for r in Q.mcd_outliers(docs.selectExpr("*", "'l' AS lang", "'s' AS source")).collect() if not r["base_failed"]]
    kept = {q: [r["kept"] for r in got if labels.get(r["doc_id"]) == q] for q in (0, 1)}
    print({q: (sum(k), len(k)) for q, k in kept.items()})
    assert len(kept[1]) > 200 and sum(kept[1]) >= 0.99 * len(kept[1])
    assert len(kept[0]) > 10 and sum(kept[0]) <= 0.2 * len(kept[0])


def test_cutoff_is_the_quantile():
    assert abs(Q.chi2_cutoff(0.5) - Q.CHI2_MEDIAN) < 1e-3 and abs(Q.chi2_cutoff(0.025) - 12.8325) < 1e-3 and abs(Q.chi2_cutoff(1e-3) - 20.515) < 1e-3


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, None, 1), (1, None, None, None, 1), (None, "", "en", None, 2), (3, "a " * 50_000, "en", "s", 3)], "doc_id long, text string, lang string, source string, g int")
    got = Q.mcd_outliers(df).collect()
    assert len(got) == 4 and not any(r["kept"] for r in got)
    assert Q.mcd_outliers(df.limit(0)).count() == 0
