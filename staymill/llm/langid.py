"""Language identification by nearest centroids of character n-gram vectors.

A text becomes a vector of its byte trigrams around letters, hashed into `BUCKETS` places, weighted by
(1 + log tf) * idf and scaled to length 1. Each language has several centroids, found by spherical k-means on a bounded
sample of its texts, since a language holds several kinds of text. A text gets the language of the nearest centroid by
cosine, and is rejected if even that one is much farther away than texts of the sample: if its cosine is below
`REJECT_FACTOR` times the one that a share of `REJECT_SHARE` of the language's sample does not reach, lowered in proportion
for texts of fewer than `REJECT_LETTERS` letters, which are far from every centroid.

Bounds: document frequencies are counted over all learnable texts; centroids are fitted on at most `ROWS` texts and
`BYTES` bytes per language. The model is languages x CENTROIDS x BUCKETS floats. Prediction is a map.

Defined cases: texts that are null or have no letter get `und`, score 0, and are rejected; so is every text if nothing can be
learned. Equal distances go to the language that comes first by name. Rows with equal ids are separate; other columns
are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill.llm.sampling import sample_by_class
from staymill.llm.words import chunks, text_buffer

BUCKETS = 4096
CENTROIDS = 4
ROWS = 600
BYTES = 4 << 20
SLICE = 256  # texts whose vectors are held at once
REJECT_SHARE = 0.001
REJECT_FACTOR = 0.5
REJECT_LETTERS = 200

_LETTER = np.full(256, 0x20, np.int64)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def _counts(chunk: pa.RecordBatch) -> np.ndarray:
    """Trigram counts, one row per text."""
    data, offsets = text_buffer(chunk.column("text"))
    n = chunk.num_rows
    if not len(data):
        return np.zeros((n, BUCKETS), np.float32)
    here = _LETTER[data]
    before, after = np.full(len(here), 0x20), np.full(len(here), 0x20)
    before[1:], after[:-1] = here[:-1], here[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]
    before[edge] = 0x20
    after[edge[1:] - 1] = 0x20
    at = np.flatnonzero(here != 0x20)
    code = (before[at] << 16 | here[at] << 8 | after[at]) * 2654435761 >> 11 & BUCKETS - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))[at]
    return np.bincount(doc * BUCKETS + code, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        for k in range(0, chunk.num_rows, SLICE):
            yield chunk.slice(k, SLICE)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(BUCKETS, np.int64), 0
    for part in _slices(batches):
        seen += (_counts(part) > 0).sum(axis=0)
        n += part.num_rows
    yield pa.RecordBatch.from_pydict({"bucket": np.arange(-1, BUCKETS), "n": np.append(n, seen)})


def _centroids(key: tuple, pdf: pd.DataFrame, idf: np.ndarray) -> pd.DataFrame:
    """Spherical k-means on the sample of one language, started from texts far from each other."""
    batch = pa.RecordBatch.from_pydict({"text": pa.array(sorted(pdf["text"]), pa.string())})
    v = np.concatenate([_vectors(_counts(part), idf) for part in _slices(iter([batch]))])
    centres = v.mean(axis=0, keepdims=True)
    while len(centres) < min(CENTROIDS, len(v)):
        centres = np.concatenate([centres, v[[np.argmin((v @ centres.T).max(axis=1))]]])
    for _ in range(12):
        nearest = (v @ centres.T).argmax(axis=1)
        centres = np.stack([v[nearest == k].mean(axis=0) if (nearest == k).any() else centres[k] for k in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    near = (v @ centres.T).max(axis=1)
    return pd.DataFrame({"lang": [key[0]], "centres": [centres.astype(np.float32).tobytes()], "reach": [float(np.quantile(near, REJECT_SHARE))]})


class Model:
    def __init__(self, langs: list[str], centres: np.ndarray, owner: np.ndarray, reach: np.ndarray, idf: np.ndarray):
        self.langs, self.centres, self.owner, self.reach, self.idf = langs, centres, owner, reach, idf


def fit(learn: DataFrame) -> Model:
    """Learn from (lang, text), neither of them null."""
    rows = learn.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows
    seen = {r["bucket"]: r["n"] for r in rows}
    idf = np.log((1 + seen.get(-1, 0)) / (1 + np.array([seen.get(b, 0) for b in range(BUCKETS)]))).astype(np.float32) + 1
    sample = sample_by_class(learn.select(F.col("lang").alias("label"), "text"), ROWS, BYTES)
    got = sample.groupBy("label").applyInPandas(lambda key, pdf: _centroids(key, pdf, idf), "lang string, centres binary, reach double").collect()
    got = sorted(got, key=lambda r: r["lang"])  # one row per language
    blocks = [np.frombuffer(r["centres"], np.float32).reshape(-1, BUCKETS) for r in got]
    centres = np.concatenate(blocks) if blocks else np.zeros((0, BUCKETS), np.float32)
    return Model([r["lang"] for r in got], centres, np.repeat(np.arange(len(blocks)), [len(b) for b in blocks]), np.array([r["reach"] for r in got]), idf)


def _predict(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model: Model = held.value
    for part in _slices(batches):
        letter = np.array(part.column("has_letter").to_pylist(), bool) & bool(len(model.langs))
        lang, near, far = np.full(part.num_rows, "und", object), np.zeros(part.num_rows), np.ones(part.num_rows, bool)
        if letter.any():
            counts = _counts(part)
            sims = _vectors(counts, model.idf) @ model.centres.T
            best = sims.argmax(axis=1)
            who = model.owner[best]
            lang = np.where(letter, np.array(model.langs, object)[who], "und")
            near = np.where(letter, np.clip(sims[np.arange(len(best)), best], 0, 1), 0).astype(float)
            certain = np.minimum(counts.sum(axis=1) / REJECT_LETTERS, 1)
            far = ~letter | (near < REJECT_FACTOR * certain * model.reach[who])
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in part.schema.names if c != "has_letter"), pa.array(lang.tolist(), pa.string()), pa.array(near, pa.float64()), pa.array(far, pa.bool_())],
            names=[*(c for c in part.schema.names if c != "has_letter"), "lang_pred", "score", "rejected"],
        )


def identify(docs: DataFrame, learnable: Column, keep: list[str], prefix: str = "") -> DataFrame:
    """Columns `keep`, `text` among them, and lang_pred, score, rejected (names after `prefix`) of every row.

    Learns from the rows where `learnable` holds and lang is known."""
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    learn = docs.where(learnable & F.col("lang").isNotNull() & letter).select("lang", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(learn))  # languages x CENTROIDS x BUCKETS floats
    names = {c: "text" if c == "text" else f"c{i}" for i, c in enumerate(keep)}
    rows = docs.select(*(F.col(f"`{c}`").alias(names[c]) for c in keep))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    found = rows.withColumn("has_letter", letter).mapInArrow(lambda it: _predict(it, model), f"{fields}, lang_pred string, score double, rejected boolean")
    return found.select(*(F.col(names[c]).alias(c) for c in keep), *(F.col(c).alias(prefix + c) for c in ("lang_pred", "score", "rejected")))
