"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._labels import WordWeights, bucket, held_out, training_sample
from judgeset.llm._tables import table, tidy

BITS = 18
_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+"), re.compile(r"\d+")


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - s), with s the weights' sum over a text's features."""

    weights: np.ndarray
    thresholds: np.ndarray


def shape(word: str) -> str:
    """A word's outline: runs of lower-case letters, capitals and digits become a, A and 0."""
    return _DIGIT.sub("0", _LOWER.sub("a", _UPPER.sub("A", word)))


def _word_features(word: str) -> tuple[int, int]:
    return bucket(word.lower(), BITS), bucket("\x00" + shape(word)[:12], BITS)


def _text_features(n: int, distinct: int) -> tuple[int, int]:
    """Hashed length class and share of words that repeat; each counts once for the whole text."""
    repeats = 0 if n == 0 else int(10 * (1 - distinct / n))
    return bucket(f"\x01length {n.bit_length()}", BITS), bucket(f"\x02repeats {min(n.bit_length(), 10)} {repeats}", BITS)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for y, text in zip(batch["y"], batch["text"], strict=True):
            words = (text or "").split()
            found = np.array([f for w in words for f in _word_features(w)], np.int64)
            at, n = np.unique(found, return_counts=True)
            whole = _text_features(len(words), len(set(words)))
            rows.append((y, [*at.tolist(), *whole], [*(n / max(1, len(words))).tolist(), 1.0, 1.0]))
        yield pd.DataFrame(rows, columns=["y", "features", "values"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def likelihood(theta: np.ndarray, grades: int, features: np.ndarray, values: np.ndarray, doc_of: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood of the grades with its penalty, and the gradient by theta: the features' weights,
    the first threshold, and the logarithms of the gaps between thresholds."""
    used, rows = len(theta) - grades + 1, np.arange(len(y))
    w, first, gaps = theta[:used], theta[used], theta[used + 1 :]
    edges = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    s = np.bincount(doc_of, w[features] * values, len(y))
    below = np.hstack([np.zeros((len(y), 1)), _sigmoid(edges[None, :] - s[:, None]), np.ones((len(y), 1))])
    slope = below * (1 - below)
    chance = np.maximum(below[rows, y + 1] - below[rows, y], 1e-9)
    scale = weight / chance
    ds = scale * (slope[rows, y + 1] - slope[rows, y])
    d_edges = np.zeros(grades + 1)
    np.add.at(d_edges, y + 1, -scale * slope[rows, y + 1])
    np.add.at(d_edges, y, scale * slope[rows, y])
    tail = np.cumsum(d_edges[1:-1][::-1])[::-1]
    shrink = penalty / used**0.5 if used else 0.0
    grad = np.concatenate([np.bincount(features, ds[doc_of] * values, used) + shrink * w, [tail[0]], tail[1:] * np.exp(gaps)])
    return float(-(weight * np.log(chance)).sum() + shrink * (w * w).sum() / 2), grad


def fit(documents: DataFrame, labels: DataFrame, grade: Column, grades: int, per_class: int = 2500, rounds: int = 200, penalty: float = 1e-4) -> OrdinalModel:
    """Fits by Adam on a bounded sample (per_class documents of each grade, weighted back to the grades' shares).

    Thresholds stay ordered: the first is free, each further one adds a positive gap. Without any label the weights
    are 0 and the thresholds evenly spaced.
    """
    sample, sizes = training_sample(documents, labels, grade, per_class)
    start = np.linspace(-1.0, 1.0, grades - 1)
    got = sample.mapInPandas(tidy(_features), "y int, features array<int>, values array<double>").toPandas() if sizes else pd.DataFrame()
    if len(got) == 0:
        return OrdinalModel(np.zeros(1 << BITS), start)
    y = np.clip(got["y"].to_numpy(), 0, grades - 1)
    features = np.concatenate([np.asarray(x, np.int64) for x in got["features"]])
    values = np.concatenate([np.asarray(x, np.float64) for x in got["values"]])
    doc_of = np.repeat(np.arange(len(got)), [len(x) for x in got["features"]])
    seen = np.bincount(features, minlength=1 << BITS)
    keep = seen[features] >= 3
    features, values, doc_of = features[keep], values[keep], doc_of[keep]
    used, features = np.unique(features, return_inverse=True)
    in_sample = np.bincount(y, minlength=grades)
    weight = np.array([sizes.get(k, 0) / max(1, in_sample[k]) for k in range(grades)])[y]
    weight = weight / weight.sum()
    theta = np.concatenate([np.zeros(len(used)), [-1.0], np.zeros(grades - 2)])
    m = v = np.zeros(len(theta))
    for t in range(1, rounds + 1):
        _, grad = likelihood(theta, grades, features, values, doc_of, y, weight, penalty)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    flat = np.zeros(1 << BITS)
    flat[used] = theta[: len(used)]
    return OrdinalModel(flat, theta[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(theta[len(used) + 1 :]))]))


def grade_documents(df: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text", at_least: int = 1) -> DataFrame:
    """doc_id, expected_grade, tail_prob (of a grade of at_least or more). Null and empty texts have no words and get
    the grade of their length class. Repeated rows are graded alone; other columns are not read."""
    shared = df.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    def grade(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, edges = shared.value

        def of_word(word: str) -> float:
            a, b = _word_features(word)
            return float(w[a]) + float(w[b])

        number = WordWeights(of_word).__getitem__
        for batch in batches:
            scores = []
            for x in batch["text"]:
                words = x.split() if x else []
                whole = _text_features(len(words), len(set(words)))
                scores.append(sum(map(number, words)) / max(1, len(words)) + float(w[whole[0]]) + float(w[whole[1]]))
            above = 1 - _sigmoid(edges[None, :] - np.array(scores)[:, None])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "expected_grade": above.sum(axis=1), "tail_prob": above[:, at_least - 1]})

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(tidy(grade), "doc_id long, expected_grade double, tail_prob double")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades 0 (bad), 1 (good but toxic) and 2 (good); kept where a grade of 1 or more is likelier than not."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    graded = grade_documents(documents, fit(documents, labels, grade, 3))
    return graded.select("doc_id", held_out().alias("held_out"), "expected_grade", "tail_prob", (F.col("tail_prob") >= 0.5).alias("kept"))
