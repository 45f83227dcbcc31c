"""Skip-gram word vectors without a vocabulary on the driver.

Every task cuts its documents into chunks of bounded size and fits the vectors of a chunk's own words, by skip-gram with
negative sampling. A word starts from a hash of its letters, so all chunks start alike and nothing is sent to them; the
vectors of a word are then averaged over chunks by its occurrences there, as Spark's `Word2Vec` averages its partitions. The
driver sees neither words nor weights, and a task holds the words of one chunk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import TEXT_ROWS, arrow_rows, materialise
from staymill.plans.barrier import uniform

CHUNK_WORDS = 1_000_000
WINDOW, RATE, NEGATIVES, SHARED, POWER = 5, 0.025, 5, 16, 0.75
STEP_WORDS = 256  # places whose pairs are trained at once
HOT = 32  # a word's step sums that many of its pairs at most, and is scaled down beyond


@dataclass(frozen=True)
class WordVectors:
    """(token, vector), one row per word."""

    table: DataFrame


def _start(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    keys = pd.util.hash_array(words, categorize=False).view(np.int64)
    return np.stack([(uniform(keys, seed * 1009 + i) - 0.5) / size for i in range(size)], axis=1)


def _add(weights: np.ndarray, at: np.ndarray, steps: np.ndarray) -> None:
    """Add steps to rows of the weights; rows that many steps meet take them scaled down."""
    rows, back, n = np.unique(at, return_inverse=True, return_counts=True)
    size = weights.shape[1]
    sums = np.bincount((back[:, None] * size + np.arange(size)).ravel(), steps.ravel(), minlength=len(rows) * size)
    weights[rows] += sums.reshape(-1, size) * np.minimum(1.0, HOT / n)[:, None]


def train(code: np.ndarray, doc: np.ndarray, start: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Vectors of the words of one chunk: `code` is the word and `doc` the document at every place."""
    inner, outer = start.astype(np.float32), np.zeros(start.shape, np.float32)
    chance = np.cumsum(np.bincount(code, minlength=len(start)) ** POWER)
    reach = draw.integers(1, WINDOW + 1, len(code))
    shift = np.concatenate([np.arange(-WINDOW, 0), np.arange(1, WINDOW + 1)])
    for first in range(0, len(code), STEP_WORDS):
        rate = np.float32(RATE * max(1e-4, 1 - first / len(code)))
        place = np.arange(first, min(first + STEP_WORDS, len(code)))
        near = place[:, None] + shift
        inside = (near >= 0) & (near < len(code)) & (np.abs(shift) <= reach[place][:, None])
        near = np.clip(near, 0, len(code) - 1)
        inside &= doc[near] == doc[place][:, None]
        if not inside.any():
            continue
        a, b = code[near[inside]], np.broadcast_to(code[place][:, None], near.shape)[inside]
        other = np.searchsorted(chance, draw.random(SHARED) * chance[-1], side="right")
        va, vb, vo = inner[a], outer[b], outer[other]
        hit = 1 - 1 / (1 + np.exp(-(va * vb).sum(axis=1)))
        miss = -1 / (1 + np.exp(-(va @ vo.T))) * np.float32(NEGATIVES / SHARED)
        miss[b[:, None] == other] = 0.0
        _add(inner, a, rate * (hit[:, None] * vb + miss @ vo))
        _add(outer, b, rate * hit[:, None] * va)
        _add(outer, other, rate * (miss.T @ va) * np.float32(min(1.0, HOT / len(a) * SHARED / NEGATIVES)))
    return inner.astype(float)


def _chunks(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[list[pa.Array]]:
    """Lists of words, whole documents, until a chunk has `words` words; a longer document is cut."""
    held, n = [], 0
    for batch in batches:
        column = batch.column(0)
        for i in range(len(column)):
            flat = column.slice(i, 1).flatten()
            for j in range(0, len(flat), words):
                part = flat.slice(j, words)
                if n and n + len(part) > words:
                    yield held
                    held, n = [], 0
                held.append(part)
                n += len(part)
    if n:
        yield held


def fit(df: DataFrame, toks: str, size: int, min_count: int, seed: int, partitions: int, chunk_words: int = CHUNK_WORDS) -> WordVectors:
    """Vectors of all words that occur `min_count` times at least, from `partitions` tasks."""
    texts = df.select(F.col(toks).alias("toks"))
    if min_count > 1:  # rarer words are taken out of the texts
        placed = materialise(texts.select(F.monotonically_increasing_id().alias("d"), F.posexplode("toks").alias("i", "t")), "places")
        kept = placed.groupBy("t").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).select("t")
        texts = placed.join(kept, "t").groupBy("d").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda x: x["t"]).alias("toks")).select("toks")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _chunks(batches, chunk_words):
            coded = pa.chunked_array(parts).combine_chunks().dictionary_encode()
            known = coded.dictionary.to_numpy(zero_copy_only=False)
            order = np.argsort(known)  # words in the order of their letters, whatever came first
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            code = place[coded.indices.to_numpy(zero_copy_only=False)]
            doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            out = train(code, doc, _start(known[order], size, seed), np.random.default_rng([seed, len(code)]))
            n = np.bincount(code, minlength=len(order))
            for i in range(0, len(order), 10_000):
                some = slice(i, i + 10_000)
                yield pa.RecordBatch.from_pydict({"token": pa.array(known[order][some], pa.string()), "n": n[some], **{f"s{j}": out[some, j] * n[some] for j in range(size)}})

    sums = ", ".join(f"s{j} double" for j in range(size))
    with arrow_rows(df.sparkSession, TEXT_ROWS):
        parts = materialise(texts.repartition(partitions).mapInArrow(vectors, f"token string, n bigint, {sums}"), "chunks")
    total = parts.groupBy("token").agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(size)])
    return WordVectors(total.select("token", F.array(*[F.col(f"s{j}") / F.col("n") for j in range(size)]).alias("vector")))
