"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, memory-mapped to score.

Counting: map tasks reduce a few megabytes of text to distinct (history, word, count) triples, which are shuffled by
ranges of the history's hash, each cut once more by the word's, so that a frequent history is spread over `SPREAD`
parts. A part sums the counts, writes its bigrams as two arrays (sorted keys, counts) and hands what it knows of each
word (tokens, distinct histories) and of each history (followers seen once, twice, more often) to the word parts,
which write the same kind of arrays per word. Only totals of the parts reach the driver.

Scoring: a map over the documents. Workers memory-map the arrays and look up sorted keys; only pages that are touched
are read. p(w|h) = (c - D(c)) / c(h) + backoff(h) * p(w), where p(w) is built in the same way from the numbers of
distinct histories and rests on a uniform share for unknown words. Every document starts in its own begin history and
closes with an end token, which counts as a token.

The arrays are files, so the folder in spark.checkpoint.dir has to be a path that all workers mount (file:).

Defined cases: a null text is empty and holds only the end token; rows without id count as id ''; rows with equal ids
are separate documents; with no training text every probability is 1; other columns are not read."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import scratch_path
from staymill.llm.words import SPACED, chunks, mix, runs, split_words, text_buffer

FLUSH_TOKENS = 2_000_000  # tokens that a map task reduces at once
PART_BIGRAMS = 2_000_000  # triples that meet in a part, about
SPREAD = 8
BEGIN, END = np.uint64(0x5BE6A1C04D3F7712), np.uint64(0xA7D21E93F0C5B648)


def _range(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + (w ^ (w >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93))


def token_stream(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, history) hashes of all tokens, and the place of each text's first token."""
    words = split_words(*text_buffer(chunk.column("text")), SPACED)
    n = chunk.num_rows
    first = words.bounds[:-1] + np.arange(n)
    w = np.empty(len(words.hash) + n, np.uint64)
    ends = words.bounds[1:] + np.arange(n)
    inside = np.ones(len(w), bool)
    inside[ends] = False
    w[inside] = words.hash
    w[ends] = END
    h = np.empty_like(w)
    h[1:] = w[:-1]
    h[first] = BEGIN
    return w, h, first


def _summed(h: np.ndarray, w: np.ndarray, c: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (h, w) in order with their counts."""
    order = np.lexsort((w, h))
    h, w = h[order], w[order]
    place = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.append(place, len(h))) if c is None else np.add.reduceat(c[order], place) if len(h) else c
    return h[place], w[place], count


def _triples(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    tokens = 0

    def send() -> Iterator[pa.RecordBatch]:
        nonlocal held, tokens
        w, h = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        held, tokens = [], 0
        h, w, c = _summed(h, w, None)
        side = (w >> np.uint64(61)).astype(np.int64)
        cut = np.searchsorted(_range(h, ranges), np.arange(ranges + 1, dtype=np.uint64))
        for r in range(ranges):
            for s in range(SPREAD):
                at = np.flatnonzero(side[cut[r] : cut[r + 1]] == s) + cut[r]
                if len(at):
                    heads = runs(h[at])
                    yield pa.RecordBatch.from_pydict({
                        "part": [r * SPREAD + s], "heads": [h[at][heads].tobytes()], "followers": [np.diff(np.append(heads, len(at))).astype(np.uint32).tobytes()],
                        "words": [w[at].tobytes()], "counts": [c[at].astype(np.uint32).tobytes()],
                    })

    for chunk in chunks(batches):
        w, h, _ = token_stream(chunk)
        held.append((w, h))
        tokens += len(w)
        if tokens >= FLUSH_TOKENS:
            yield from send()
    if held:
        yield from send()


def _save(folder: str, name: str, *arrays: np.ndarray) -> None:
    """One file of equally long 8-byte columns; a second attempt of a task replaces it by an equal one."""
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(draft, "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).data)
    os.replace(draft, f"{folder}/{name}")


def _bigram_part(pdf: pd.DataFrame, folder: str, word_parts: int) -> pd.DataFrame:
    part = int(pdf["part"].iloc[0])
    column = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in pdf[name]])
    h = np.repeat(column("heads", np.uint64), column("followers", np.uint32))
    h, w, c = _summed(h, column("words", np.uint64), column("counts", np.uint32).astype(np.int64))
    key = _key(h, w)
    order = np.argsort(key)
    _save(folder, f"bigrams-{part:06d}", key[order], c[order])
    head = runs(h)
    seen = [np.add.reduceat(x.astype(np.int64), head) for x in (c == 1, c == 2, c >= 3)]
    by_word = np.argsort(w)
    place = runs(w[by_word])
    met, tokens = np.diff(np.append(place, len(w))), np.add.reduceat(c[by_word], place)
    rows = [(part % word_parts, "size", b"", [np.bincount(np.minimum(c, 5), minlength=6)[1:5].astype(np.int64).tobytes()])]
    for kind, words, values in (("history", h[head], seen), ("word", w[by_word][place], [tokens, met])):
        cut = np.searchsorted(_range(words, word_parts), np.arange(word_parts + 1, dtype=np.uint64))
        for p, (a, b) in enumerate(zip(cut, cut[1:])):
            if b > a:
                rows.append((p, kind, words[a:b].tobytes(), [v[a:b].astype(np.int64).tobytes() for v in values]))
    return pd.DataFrame(rows, columns=["part", "kind", "words", "values"])


def _word_part(key: tuple, pdf: pd.DataFrame, folder: str) -> pd.DataFrame:
    sizes = sum((np.frombuffer(v[0], np.int64) for k, v in zip(pdf["kind"], pdf["values"]) if k == "size"), np.zeros(4, np.int64))
    words = np.unique(np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["words"]]))
    tables = {"word": np.zeros((2, len(words)), np.int64), "history": np.zeros((3, len(words)), np.int64)}
    for kind, b, values in zip(pdf["kind"], pdf["words"], pdf["values"]):
        if kind != "size":
            at = np.searchsorted(words, np.frombuffer(b, np.uint64))  # a row names a word once
            for row, v in zip(tables[kind], values):
                row[at] += np.frombuffer(v, np.int64)
    tokens, met = tables["word"]
    _save(folder, f"words-{key[0]:06d}", words, tokens, met, *tables["history"])
    kinds = np.bincount(np.minimum(met, 5), minlength=6)[1:5]
    return pd.DataFrame({"tokens": [int(tokens.sum())], "words": [int((tokens > 0).sum())], "bigrams": [int(met.sum())], "pairs_of": [sizes.tolist()], "words_of": [kinds.tolist()]})


def discounts(n: list[int]) -> list[float]:
    """D(1), D(2), D(3 and more) from the numbers of things seen 1 to 4 times."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.0), i) for i, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), 1)]


class Model:
    """The arrays of a folder, memory-mapped."""

    def __init__(self, folder: str, ranges: int, word_parts: int, texts: int, totals: dict):
        self.folder, self.ranges, self.word_parts, self.texts = folder, ranges, word_parts, texts
        self.tokens, self.words, self.bigrams = totals["tokens"], totals["words"], totals["bigrams"]
        self.high, self.low = np.array([0.0, *discounts(totals["pairs_of"])]), np.array([0.0, *discounts(totals["words_of"])])
        n = totals["words_of_3"]
        self.rest = float(self.low[1:] @ np.array(n)) / self.bigrams if self.bigrams else 1.0
        self.open: dict[str, np.ndarray | None] = {}
        self.unknown = self.rest / (self.words + 1)

    def _columns(self, name: str, width: int) -> np.ndarray | None:
        if name not in self.open:
            path = f"{self.folder}/{name}"
            there = os.path.exists(path) and os.path.getsize(path)
            self.open[name] = np.memmap(path, np.int64, "r").reshape(width, -1) if there else None
        return self.open[name]

    def _find(self, kind: str, width: int, keys: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
        """Values of each key: width - 1 rows, 0 where it is not stored."""
        out = np.zeros((width - 1, len(keys)), np.int64)
        order = np.argsort((part.astype(np.uint64) << np.uint64(44)) | (keys >> np.uint64(20)))
        cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=part.dtype))
        for p in range(parts):
            at = order[cut[p] : cut[p + 1]]
            if len(at) and (columns := self._columns(f"{kind}-{p:06d}", width)) is not None:
                stored, wanted = columns[0].view(np.uint64), keys[at]
                spot = np.minimum(np.searchsorted(stored, wanted), len(stored) - 1)
                hit = stored[spot] == wanted
                out[:, at[hit]] = columns[1:, spot[hit]]
        return out

    def score(self, w: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(training count of the word, log10 p(w|h)) for each token."""
        kinds, inverse = np.unique(np.concatenate([w, h]), return_inverse=True)
        tokens, met, once, twice, more = self._find("words", 6, kinds, _range(kinds, self.word_parts), self.word_parts)
        low = np.full(len(kinds), self.unknown)
        if self.bigrams:
            low += np.maximum(met - self.low[np.minimum(met, 3)], 0) / self.bigrams
        total = np.where(kinds == BEGIN, self.texts, tokens)
        left = self.high[1] * once + self.high[2] * twice + self.high[3] * more
        w_at, h_at = inverse[: len(w)], inverse[len(w) :]
        part = _range(h, self.ranges) * np.uint64(SPREAD) + (w >> np.uint64(61))
        (c,) = self._find("bigrams", 2, _key(h, w), part, self.ranges * SPREAD)
        n = total[h_at]
        p = low[w_at]
        known = n > 0
        p[known] = (np.maximum(c - self.high[np.minimum(c, 3)], 0)[known] + left[h_at][known] * p[known]) / n[known]
        return tokens[w_at], np.log10(p)


def _mounted(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    if colon and scheme != "file":
        raise ValueError("the model is memory-mapped: spark.checkpoint.dir has to be a mounted folder (file:)")
    return "/" + (rest if colon else path).lstrip("/")


def fit(docs: DataFrame) -> Model:
    """Count the column `text` of all rows and write the model to the shared folder."""
    folder = _mounted(scratch_path(docs.sparkSession, "kneser-ney"))
    os.makedirs(folder)
    size, texts = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = max(2, -(-(size or 0) // 10 // PART_BIGRAMS // SPREAD))  # about one distinct triple for 10 bytes of text
    word_parts = max(6, ranges * SPREAD // 4)
    triples = docs.select("text").mapInArrow(lambda it: _triples(it, ranges), "part long, heads binary, followers binary, words binary, counts binary")
    known = triples.groupBy("part").applyInPandas(lambda pdf: _bigram_part(pdf, folder, word_parts), "part long, kind string, words binary, values array<binary>")
    sums = known.groupBy("part").applyInPandas(lambda key, pdf: _word_part(key, pdf, folder), "tokens long, words long, bigrams long, pairs_of array<long>, words_of array<long>").collect()
    totals: dict = {k: sum(r[k] for r in sums) for k in ("tokens", "words", "bigrams")}
    totals |= {k: [sum(x) for x in zip(*(r[k] for r in sums))] or [0] * 4 for k in ("pairs_of", "words_of")}
    one, two = totals["words_of"][:2]
    totals["words_of_3"] = [one, two, totals["words"] - one - two]
    return Model(folder, ranges, word_parts, texts, totals)


def _scored(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model: Model = held.value
    base_low = np.log10(model.tokens + 0.5 * (model.words + 1))
    for chunk in chunks(batches):
        w, h, first = token_stream(chunk)
        c, p = model.score(w, h)
        n = np.diff(np.append(first, len(w)))
        yield pa.RecordBatch.from_pydict({
            "doc_id": chunk.column("doc_id"), "held_out": chunk.column("held_out"), "n_tokens": pa.array(n, pa.int64()),
            "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), first), pa.int64()), "train_tokens": pa.array(np.full(len(n), model.tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(np.log10(c + 0.5) - base_low, first)), "score": pa.array(np.add.reduceat(p, first)),
        })


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Fit on the rows that are not held out, and score all: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity)."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    model = docs.sparkSession.sparkContext.broadcast(fit(marked.where(~F.col("held_out"))))  # paths and totals only
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return marked.mapInArrow(lambda it: _scored(it, model), schema).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
