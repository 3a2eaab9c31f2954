"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._labels import WordWeights, bucket, held_out, training_sample
from judgeset.llm._tables import table, tidy

BITS = 18
SENTENCE = re.compile(r"[^.!?\n]+")
_PUNCTUATION = str.maketrans(dict.fromkeys(",;:\"()[]{}<>*#$%&|/\\'`~^_=+-", " "))
SPANS = "array<struct<start:int,length:int,score:double>>"


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and lower-case words of every sentence that has a word."""
    low = text.lower()
    if len(low) != len(text):  # a few letters change length; offsets count in the text itself
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    low = low.translate(_PUNCTUATION)
    out = [(m.start(), m.end(), m.group().split()) for m in SENTENCE.finditer(low)]
    return [x for x in out if x[2]]


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for y, text in zip(batch["y"], batch["text"], strict=True):
            got = sentences(text or "")
            flat = [sorted({bucket(w, BITS) for w in words}) for *_, words in got]
            rows.append((y, [f for s in flat for f in s], [len(s) for s in flat]))
        yield pd.DataFrame(rows, columns=["y", "features", "sizes"])


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 2500) -> np.ndarray:
    """Weights of the hashed words, with the bias last.

    A sentence is toxic with probability sigmoid(bias + sum of its words' weights), a document with noisy-or over its
    sentences. Fitted on all of a bounded sample (per_class documents of each label, weighted back to the labels' true
    shares). Without labels of both kinds all weights are 0 and the bias gives every sentence 1e-4.
    """
    sample, sizes = training_sample(documents, labels, F.col(label), per_class)
    got = sample.mapInPandas(tidy(_features), "y int, features array<int>, sizes array<int>").toPandas() if sizes else pd.DataFrame()
    return train(got, sizes)


def likelihood(theta: np.ndarray, features: np.ndarray, sentence_of: np.ndarray, doc_of: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood of the documents' labels, and its gradient by theta (word weights, then bias).

    features and sentence_of name a word and its sentence for every occurrence, doc_of the document of a sentence.
    """
    w, b, docs = theta[:-1], theta[-1], len(y)
    z = b + np.bincount(sentence_of, w[features], len(doc_of))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    total = np.clip(np.bincount(doc_of, np.logaddexp(0, z), docs), 1e-6, 50)  # -log of the chance that no sentence is toxic
    loss = float((weight * np.where(y, -np.log(-np.expm1(-total)), total)).sum())
    pull = weight * np.where(y, -1 / np.expm1(total), 1.0)
    dz = pull[doc_of] * p
    return loss, np.append(np.bincount(features, dz[sentence_of], len(w)), dz.sum())


def train(got: pd.DataFrame, sizes: dict[int, int], rounds: int = 150, evidence: float = 4.0, decay: float = 1e-3, rate: float = 0.2) -> np.ndarray:
    """Adam with weight decay on the labels' likelihood, over the words whose share of positive documents exceeds the
    sample's by evidence standard errors or more; all other words weigh 0."""
    flat = np.zeros((1 << BITS) + 1)
    flat[-1] = -9.2
    if len(got) == 0 or got["y"].nunique() < 2:
        return flat
    y = got["y"].to_numpy() == 1
    features = np.concatenate([np.asarray(x, np.int64) for x in got["features"]])
    words_in = np.concatenate([np.asarray(x, np.int64) for x in got["sizes"]])
    per_doc = np.array([len(x) for x in got["sizes"]])
    doc_of = np.repeat(np.arange(len(got)), per_doc)
    sentence_of = np.repeat(np.arange(len(words_in)), words_in)
    once = np.unique(doc_of[sentence_of] * (1 << BITS) + features)
    seen = np.bincount(once % (1 << BITS), minlength=1 << BITS)
    bad = np.bincount(once[y[once >> BITS]] % (1 << BITS), minlength=1 << BITS)
    prior = float(np.bincount(y[once >> BITS])[1] / len(once))  # share of word occurrences, so that long documents count as such
    useful = ((bad - seen * prior) >= evidence * np.sqrt(seen * prior * (1 - prior) + 0.5))[features]
    features, sentence_of = features[useful], sentence_of[useful]
    used, features = np.unique(features, return_inverse=True)
    share = {k: sizes[k] / max(1, int((y == bool(k)).sum())) for k in (0, 1)}
    weight = np.where(y, share[1], share[0])
    weight = weight / weight.sum()
    theta = np.append(np.zeros(len(used)), -6.0)
    m = v = np.zeros(len(theta))
    keep = np.append(np.full(len(used), 1 - rate * decay), 1.0)
    for t in range(1, rounds + 1):
        _, grad = likelihood(theta, features, sentence_of, doc_of, y, weight)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta * keep - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    flat[used], flat[-1] = theta[:-1], theta[-1]
    return flat


def score_documents(df: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text", offending: float = 0.5) -> DataFrame:
    """doc_id, score (noisy-or of sentence scores; 0 to 1) and sentences (start and length in characters, score) whose
    own score is at least offending. Null and empty texts have no sentence and score 0. Repeated rows are scored alone."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))  # fixed size: 2^BITS + 1 numbers

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        bias = float(w[-1])
        number = WordWeights(lambda word: float(w[bucket(word, BITS)])).__getitem__
        for batch in batches:
            scores, spans = [], []
            for x in batch["text"]:
                found = sentences(x) if x else []
                z = np.array([bias + sum(map(number, set(words))) for *_, words in found])
                scores.append(float(-np.expm1(-np.logaddexp(0, z).sum())) if len(z) else 0.0)
                spans.append([{"start": found[i][0], "length": found[i][1] - found[i][0], "score": float(1 / (1 + np.exp(-z[i])))} for i in np.flatnonzero(z >= np.log(offending / (1 - offending)))] if len(z) else [])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": scores, "sentences": spans})

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(tidy(score), f"doc_id long, score double, sentences {SPANS}")


def reject_toxic(df: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """df without the rows whose score reaches threshold; all columns pass through untouched, whatever their names. Null
    and empty texts score 0 and stay."""
    shared = df.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        bias = float(w[-1])
        number = WordWeights(lambda word: float(w[bucket(word, BITS)])).__getitem__
        for texts in batches:
            z = [[bias + sum(map(number, set(words))) for *_, words in (sentences(x) if x else [])] for x in texts]
            yield pd.Series([float(-np.expm1(-np.logaddexp(0, np.array(y)).sum())) if y else 0.0 for y in z], dtype="float64")

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from tidy(scores)(batches)

    return df.filter(score(F.col(text)) < threshold)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_documents(documents, fit(documents, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("sentences").alias("n_offending"), "sentences",
    )
