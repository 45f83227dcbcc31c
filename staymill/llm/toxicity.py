"""Toxicity by two class-conditional Kneser-Ney bigram models, one of toxic and one of ordinary texts.

p(w|h) of a class interpolates its bigrams with its words, counted by the histories they were met after, and those with
backoff counts that both classes share: in how many classes a word was met. A bigram met once in a class, which in a
large vocabulary is mostly chance, is discounted whole, so that rare expressions are left to the backoff.
The log-likelihood ratios of both orders are normalised by length, over the whole text and over its most toxic stretches
of `STRETCHES` words, since a few words can make a long text toxic. A logistic regression turns these ratios into a
probability; each text it is fitted on is rated by counts of the other folds.

Bounds: both are fitted on at most `ROWS` texts and `BYTES` bytes per class, so the model is a few megabytes; scoring
is a map that looks up sorted hash arrays.

Defined cases: a null or empty text has all ratios 0. With one class or none to learn from, every score is the share of
toxic labels (0.0 without labels). Rows of labels without label, or whose text is null, teach nothing; a doc_id with several labels
counts as toxic if one of them is. Rows with equal ids are separate; other columns are not read."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill.llm.sampling import sample_by_class
from staymill.llm.words import ALNUM, chunks, find, mix, runs, split_words, text_buffer

ROWS = 3000
BYTES = 12 << 20
STRETCHES = (1, 3, 10)
FEATURES = 2 * (1 + len(STRETCHES))
FOLDS = 4
_BEGIN = np.uint64(0x5BE6A1C04D3F7712)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, bigram key, bounds) of all texts."""
    words = split_words(*text_buffer(column), ALNUM)
    h = np.empty_like(words.hash)
    h[1:] = words.hash[:-1]
    h[words.bounds[:-1][np.diff(words.bounds) > 0]] = _BEGIN
    return words.hash, h, words.bounds


def _key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + mix(w))


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


class Counts:
    """Sorted hash arrays: words with the log ratio of their two probabilities and backoffs, bigrams with what they add."""

    def __init__(self, w: np.ndarray, h: np.ndarray, toxic: np.ndarray):
        """Tokens with their histories; `toxic` marks the class of each."""
        self.words = np.unique(np.concatenate([w, h]))
        v = len(self.words)
        wi, hi = np.searchsorted(self.words, w), np.searchsorted(self.words, h)
        triple, n = np.unique((hi * v + wi) * 2 + toxic, return_counts=True)
        ph, pw, pc = triple // (2 * v), triple // 2 % v, triple % 2
        met = np.zeros(v) + 0.5  # shared: classes of each word
        for c in (0, 1):
            met += np.bincount(pw[pc == c], minlength=v) > 0
        total = met.sum() + 0.5
        shared, self.unseen = met / total, 0.5 / total
        self.p, self.back = np.zeros((2, v)), np.ones((2, v))
        add = np.zeros((2, len(n)))
        self.low_share = np.ones(2)
        for c in (0, 1):
            mine = pc == c
            after = np.bincount(pw[mine], minlength=v)  # histories of each word
            d = _discount(after)
            size = max(after.sum(), 1.0)
            self.low_share[c] = d * (after > 0).sum() / size if after.any() else 1.0
            self.p[c] = np.maximum(after - d, 0) / size + self.low_share[c] * shared
            history = np.bincount(ph[mine], n[mine], minlength=v)
            off = np.where(n[mine] == 1, 1.0, _discount(n[mine]))
            taken = np.bincount(ph[mine], off, minlength=v)
            self.back[c] = np.where(history > 0, taken / np.maximum(history, 1), 1.0)
            add[c, mine] = (n[mine] - off) / history[ph[mine]]
        several = n > 1
        ph, pw, add = ph[several], pw[several], add[:, several]
        key = _key(self.words[ph], self.words[pw])
        order = np.argsort(key)
        key, add = key[order], add[:, order]
        first = runs(key)
        self.bigrams, self.add = key[first], np.add.reduceat(add, first, axis=1) if len(first) else add
        self.p, self.back, self.add = (x.astype(np.float32) for x in (self.p, self.back, self.add))

    def ratios(self, w: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log p_toxic - log p_ordinary of each token: by its word alone, and after its history."""
        kinds, inverse = np.unique(np.concatenate([w, h]), return_inverse=True)
        at = find(self.words, kinds)
        low = np.where(at >= 0, self.p[:, at], self.low_share[:, None] * self.unseen)[:, inverse[: len(w)]]
        back = np.where(at >= 0, self.back[:, at], 1.0)[:, inverse[len(w) :]]
        spot = find(self.bigrams, _key(h, w))
        p = back * low + np.where(spot >= 0, self.add[:, spot] if self.add.shape[1] else 0, 0)
        return np.log(low[1]) - np.log(low[0]), np.log(p[1]) - np.log(p[0])

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text, for either order: the mean ratio, and the highest mean ratio of a stretch of each length."""
        w, h, bounds = _tokens(column)
        out = np.zeros((len(bounds) - 1, FEATURES))
        size = np.diff(bounds)
        full = size > 0
        if not len(w):
            return out
        end, start = np.repeat(bounds[1:], size), np.arange(len(w))
        for order, ratio in enumerate(self.ratios(w, h)):
            first = order * (FEATURES // 2)
            run = np.concatenate([[0], np.cumsum(ratio)])
            out[:, first] = (run[bounds[1:]] - run[bounds[:-1]]) / np.maximum(size, 1)
            for k, width in enumerate(STRETCHES, 1):
                stop = np.minimum(start + width, end)  # a stretch that reaches past the end counts as filled up with 0
                out[full, first + k] = np.maximum.reduceat((run[stop] - run[start]) / width, bounds[:-1][full])
        return out


class Model:
    def __init__(self, counts: Counts | None, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, share: float):
        self.counts, self.mean, self.scale, self.weights, self.share = counts, mean, scale, weights, share

    def score(self, column: pa.Array) -> np.ndarray:
        if self.counts is None:
            return np.full(len(column), self.share)
        x = (self.counts.features(column) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Intercept and weights by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(b))
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -40, 40)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + penalty, a.T @ (weight * (y - p)) - penalty @ b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """One pickled model from the whole sample. The logistic regression sees ratios from counts without the text's fold."""
    rows = sorted(zip(pdf["label"], pdf["text"], pdf["n"]))
    y = np.array([label for label, _, _ in rows])
    sizes = {int(label): int(n) for label, _, n in rows}
    if set(sizes) != {0, 1}:
        return pd.DataFrame({"model": [pickle.dumps(Model(None, np.zeros(0), np.zeros(0), np.zeros(0), float(set(sizes) == {1})))]})
    texts = pa.array([text for _, text, _ in rows], pa.string())
    w, h, bounds = _tokens(texts)
    size = np.diff(bounds)
    fold = np.concatenate([np.arange(int((y == c).sum())) for c in (0, 1)]) % FOLDS
    x = np.zeros((len(y), FEATURES))
    toxic, of = np.repeat(y, size), np.repeat(fold, size)
    for f in range(FOLDS):
        rest = of != f
        if (fold == f).any():
            x[fold == f] = Counts(w[rest], h[rest], toxic[rest]).features(texts.filter(pa.array(fold == f)))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weight = np.array([sizes[c] / (y == c).sum() for c in (0, 1)]) * len(y) / sum(sizes.values())
    model = Model(Counts(w, h, toxic), mean, scale, _logistic((x - mean) / scale, y, weight[y]), 0.0)
    return pd.DataFrame({"model": [pickle.dumps(model)]})


def fit(texts: DataFrame, labels: DataFrame, rows: int = ROWS, size: int = BYTES) -> Model:
    """Learn from `texts` (doc_id, text) and `labels` (doc_id, label), no nulls; a label is 0 or 1."""
    sample = sample_by_class(texts, rows, size, labels)  # bounded, so one task may fit it
    got = sample.groupBy(F.lit(0).alias("all")).applyInPandas(_fit, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else Model(None, np.zeros(0), np.zeros(0), np.zeros(0), 0.0)


def _predict(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        score = held.value.score(chunk.column("text"))
        yield pa.RecordBatch.from_pydict({
            "doc_id": chunk.column("doc_id"), "held_out": chunk.column("held_out"), "score": pa.array(score, pa.float64()), "predicted": pa.array((score >= 0.5).astype(np.int32)),
        })


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; learns from `labels` (doc_id, toxic) of rows that are not held out."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    learn = marked.where(~F.col("held_out") & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(learn, known))  # bounded by ROWS and BYTES
    return marked.mapInArrow(lambda it: _predict(it, model), "doc_id long, held_out boolean, score double, predicted int")
