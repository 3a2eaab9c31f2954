import numpy as np
import pytest
from pyspark.sql import functions as F

from judgeset.llm import quality_classifier as QC
from judgeset.llm import toxicity as TX


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable")) + 1.0
    n = y.sum()
    return (order[y].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.fixture(scope="module")
def planted(spark):
    """Long documents of common words; a bad one has one sentence with a word that marks it."""
    rng = np.random.default_rng(4)
    words = np.array([f"word{i}" for i in range(300)])
    rows = []
    for i in range(900):
        bad = i % 5 == 0
        sentences = [" ".join(rng.choice(words, int(rng.integers(3, 12)))) for _ in range(int(rng.integers(1, 15)))]
        if bad:
            sentences[int(rng.integers(len(sentences)))] += " " + str(rng.choice(["vile", "awful"])) + " word1"
        rows.append((i, ". ".join(sentences) + ".", int(not bad and i % 3 > 0), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "quality", "toxic")


def test_toxicity_finds_documents_and_sentences(planted):
    docs, labels = planted
    w = TX.fit(docs, labels)
    got = TX.score_documents(docs, w).join(labels, "doc_id").join(docs, "doc_id").collect()
    assert auc(np.array([r["toxic"] == 1 for r in got]), np.array([r["score"] for r in got])) > 0.99
    for r in got:
        assert 0 <= r["score"] <= 1
        for s in r["sentences"]:
            assert any(x in r["text"][s["start"] : s["start"] + s["length"]] for x in ("vile", "awful"))
    kept = {r["doc_id"] for r in TX.reject_toxic(docs, w).collect()}
    assert kept == {r["doc_id"] for r in got if r["score"] < 0.5}


def test_held_out_accuracy(spark):
    from judgeset.llm.quality_classifier import op10_quality_classifier
    from judgeset.llm.toxicity import op8_toxicity

    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = op8_toxicity(spark, d).join(labels, "doc_id").filter("held_out").collect()
    assert auc(np.array([r["toxic"] == 1 for r in got]), np.array([r["score"] for r in got])) > 0.9
    good = op10_quality_classifier(spark, d).join(labels, "doc_id").filter("held_out").collect()
    assert auc(np.array([r["quality"] == 1 for r in good]), np.array([r["tail_prob"] for r in good])) > 0.95
    assert np.mean([r["kept"] for r in good if r["quality"] == 1]) > 0.97


def test_thresholds_are_ordered(planted):
    docs, labels = planted
    m = QC.fit(docs, labels, F.col("quality") + F.when(F.col("toxic") == 0, 1).otherwise(0), 3, rounds=60)
    assert np.all(np.diff(m.thresholds) > 0)
    for r in QC.grade_documents(docs, m).collect():
        assert 0 <= r["tail_prob"] <= 1 and 0 <= r["expected_grade"] <= 2


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "", 2), (4, "x" * 100_000 + " y. " * 20_000, 3), (5, "İ ß. \x00", 3)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        w = TX.fit(docs, labels)
        assert sorted(r["score"] for r in TX.score_documents(docs, w).collect())[:3] == [0.0, 0.0, 0.0]
        assert TX.reject_toxic(docs, w).columns == docs.columns
        m = QC.fit(docs, labels, F.col("quality"), 2)
        assert QC.grade_documents(docs, m).count() == 5
    assert TX.score_documents(docs.limit(0), w).count() == 0 and QC.grade_documents(docs.limit(0), m).count() == 0


def _crc(word, bits=18):
    import zlib

    return zlib.crc32(word.encode()) % 2**bits


def test_scores_match_plain_python(spark, small):
    """Noisy-or over sentences, and grades of hashed texts, recomputed word by word from the weights."""
    import math
    import re

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, "One. TWO! three? \n four: (five); <six>"), (-4, "...")]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.read.parquet(f"{small}/labels.parquet")
    w = TX.fit(docs, labels)
    w = (w + np.where(np.arange(len(w)) % 97 == 0, 3.0, 0.0)).astype(np.float32)
    got = {r["doc_id"]: r["score"] for r in TX.score_documents(docs, w).collect()}
    for i, text in rows:
        clean = 1.0
        for sentence in re.split(r"[.!?\n]", (text or "").lower()):
            words = set(re.sub(r"[,;:\"()\[\]{}<>*#$%&|/\\'`~^_=+-]", " ", sentence).split())
            if words:
                clean *= 1 - 1 / (1 + math.exp(-(float(w[-1]) + sum(float(w[_crc(x)]) for x in words))))
        assert abs(got[i] - (1 - clean)) < 1e-9, i

    model = QC.fit(docs, labels, F.col("quality") + F.when(F.col("toxic") == 0, 1).otherwise(0), 3, rounds=40)
    found = {r["doc_id"]: r for r in QC.grade_documents(docs, model, at_least=2).collect()}
    v = model.weights.astype(np.float32)
    for i, text in rows:
        words = (text or "").split()
        shape = lambda x: re.sub(r"\d+", "0", re.sub(r"[^\W\d_A-Z]+", "a", re.sub(r"[A-Z]+", "A", x)))[:12]
        s = sum(float(v[_crc(x.lower())]) + float(v[_crc("\x00" + shape(x))]) for x in words) / max(1, len(words))
        n = len(words).bit_length()
        s += float(v[_crc(f"\x01length {n}")]) + float(v[_crc(f"\x02repeats {min(n, 10)} {int(10 * (1 - len(set(words)) / len(words))) if words else 0}")])
        above = [1 / (1 + math.exp(-(s - e))) for e in model.thresholds]
        assert abs(found[i]["expected_grade"] - sum(above)) < 1e-9 and abs(found[i]["tail_prob"] - above[1]) < 1e-9, i


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(1)

    def check(f, theta):
        grad = f(theta)[1]
        for i in range(len(theta)):
            step = np.zeros(len(theta))
            step[i] = 1e-6
            assert abs((f(theta + step)[0] - f(theta - step)[0]) / 2e-6 - grad[i]) < 1e-6

    doc_of = np.sort(rng.integers(0, 12, 40))
    doc_of[:12] = np.arange(12)
    doc_of.sort()
    sentence_of = np.sort(rng.integers(0, 40, 150))
    features, weight = rng.integers(0, 9, 150), rng.dirichlet(np.ones(12))
    y = rng.integers(0, 2, 12) == 1
    check(lambda t: TX.likelihood(t, features, sentence_of, doc_of, y, weight), rng.normal(size=10))
    grades = rng.integers(0, 4, 12)
    in_doc = np.sort(rng.integers(0, 12, 150))
    values = rng.random(150)
    check(lambda t: QC.likelihood(t, 4, features, values, in_doc, grades, weight, 1e-2), rng.normal(size=12))
