"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector over hashed text features is shared by all grades, the
thresholds are ordered. The expected grade ranks documents, the tail probability P(grade >= g) selects them.

Features of a text are its words, the shape of each word (letter case, digits and marks at its ends) and whether a
word repeats the one before, hashed into `BUCKETS` places; counts enter as 1 + log and the vector has length 1.

Bounds: fitted on at most `ROWS` texts and `BYTES` bytes per grade, weights are BUCKETS doubles. Scoring is a map.

Defined cases: null and empty texts have no features, so the thresholds alone rate them. With fewer than two grades
to learn from, the only grade (or 0) is expected everywhere with tail 1 if it reaches g, else 0. Of several grades of one doc_id
the lowest counts; ratings without id or grade teach nothing. Rows with equal ids are separate; other columns are not read."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill.llm.sampling import sample_by_class
from staymill.llm.words import SPACED, chunks, mix, runs, split_words, text_buffer

BUCKETS = 1 << 16
ROWS = 3000
BYTES = 8 << 20
STEPS = 300
RIDGE = 1e-4

_KIND = np.full(256, 9, np.uint64)  # letters beyond ASCII
_KIND[:0x80] = np.arange(0x80)
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A] = 1, 2, 3


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the features that are not 0, in order of texts."""
    words = split_words(*text_buffer(column), SPACED)
    n = len(words.hash)
    doc = np.repeat(np.arange(len(column)), np.diff(words.bounds))
    kind = _KIND[words.data] if n else np.zeros(1, np.uint64)
    first, second, last, previous = (kind[np.clip(at, words.start, words.end - 1)] for at in (words.start, words.start + 1, words.end - 1, words.end - 2))
    shape = mix(first | second << np.uint64(8) | last << np.uint64(16) | previous << np.uint64(24) | np.uint64(1 << 40))
    again = np.zeros(n, bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    keys = np.concatenate([words.hash, shape, np.where(again, np.uint64(7 << 50), np.uint64(5 << 50))])
    cell = np.tile(doc, 3).astype(np.int64) * BUCKETS + (mix(keys) >> np.uint64(48)).astype(np.int64)
    cell, count = np.unique(cell, return_counts=True)
    text, value = cell // BUCKETS, 1 + np.log(count)
    if len(cell):
        place = runs(text)
        norm = np.sqrt(np.add.reduceat(value * value, place))
        value = value / np.repeat(norm, np.diff(np.append(place, len(text))))
    return text, cell % BUCKETS, value


def _all_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of many texts, found a chunk at a time; only what is not 0 is kept."""
    parts, first = [], 0
    for chunk in chunks(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])])):
        text, bucket, value = _features(chunk.column("text"))
        parts.append((text + first, bucket.astype(np.int32), value))
        first += chunk.num_rows
    return tuple(np.concatenate(p) for p in zip(*parts))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def tails(self, column: pa.Array) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1, 2, ..., one row per text."""
        text, bucket, value = _features(column)
        score = np.bincount(text, self.weights[bucket] * value, minlength=len(column))
        return 1 - _sigmoid(self.thresholds[None, :] - score[:, None])


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """Adam on the weighted log-likelihood; the first threshold is free, the others follow by positive gaps."""
    rows = sorted(zip(pdf["label"], pdf["text"], pdf["n"]))
    grades = sorted({int(g) for g, _, _ in rows})
    y = np.searchsorted(grades, [g for g, _, _ in rows])
    weight = np.array([n for _, _, n in rows], float) / np.bincount(y)[y]  # each text stands for as many of its grade
    weight /= weight.sum()
    text, bucket, value = _all_features([t for _, t, _ in rows])
    used, bucket = np.unique(bucket, return_inverse=True)
    k = len(grades) - 1
    share = np.cumsum(np.bincount(y, weight))[:-1].clip(1e-6, 1 - 1e-6)
    start = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1 if k else 1):
        w, gaps = p[: len(used)], np.exp(p[len(used) + 1 :])
        limit = np.concatenate([[-np.inf], p[len(used)] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        z = np.bincount(text, w[bucket] * value, minlength=len(y))
        upper, lower = _sigmoid(limit[y + 1] - z), _sigmoid(limit[y] - z)
        likely = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        by_limit = np.bincount(y + 1, -weight * du, minlength=k + 2) + np.bincount(y, weight * dl, minlength=k + 2)
        by_limit = by_limit[1:-1]
        tail = np.cumsum(by_limit[::-1])[::-1]
        slope = np.concatenate([np.bincount(bucket, (weight * (du - dl))[text] * value, minlength=len(used)) + RIDGE * w, tail[:1], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[used] = p[: len(used)]
    thresholds = p[len(used)] + np.concatenate([[0], np.cumsum(np.exp(p[len(used) + 1 :]))]) if k else np.zeros(0)
    return pd.DataFrame({"model": [pickle.dumps(Model(grades, weights, thresholds))]})


def fit(texts: DataFrame, ratings: DataFrame, rows: int = ROWS, size: int = BYTES) -> Model:
    """Learn from `texts` (doc_id, text) and `ratings` (doc_id, label), no nulls; a label is an integer grade."""
    sample = sample_by_class(texts, rows, size, ratings)  # bounded, so one task may fit it
    got = sample.groupBy(F.lit(0).alias("all")).applyInPandas(_fit, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else Model([0], np.zeros(BUCKETS), np.zeros(0))


def _predict(batches: Iterator[pa.RecordBatch], held, at_least: int) -> Iterator[pa.RecordBatch]:
    model: Model = held.value
    grades = np.array(model.grades, float)
    for chunk in chunks(batches):
        tails = model.tails(chunk.column("text"))
        expected = grades[0] + tails @ np.diff(grades)
        k = int(np.searchsorted(grades, at_least))  # the first grade that reaches it
        tail = np.ones(len(tails)) if k == 0 else tails[:, k - 1] if k < len(grades) else np.zeros(len(tails))
        yield pa.RecordBatch.from_pydict({
            "doc_id": chunk.column("doc_id"), "held_out": chunk.column("held_out"), "expected_grade": pa.array(expected, pa.float64()), "tail": pa.array(tail, pa.float64()),
        })


def rate(docs: DataFrame, ratings: DataFrame, held_out: Column, at_least: int = 1, keep_from: float = 0.5) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail, selected) of every row; learns from `ratings` (doc_id, grade) of rows not held out."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    known = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("int").alias("label"))
    learn = marked.where(~F.col("held_out") & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(learn, known))  # BUCKETS weights
    found = marked.mapInArrow(lambda it: _predict(it, model, at_least), "doc_id long, held_out boolean, expected_grade double, tail double")
    return found.withColumn("selected", F.col("tail") >= keep_from)
