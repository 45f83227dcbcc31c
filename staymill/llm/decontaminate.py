"""Benchmark decontamination with a distributed positional inverted index.

The corpus is cut into segments. A segment of the index stores, for every term of its documents, the sorted places
where it occurs (documents stand one after the other with a gap, so no phrase crosses from one to the next). The
index is a table in the shared folder and serves any number of test sets. A test phrase is looked up in a segment by
intersecting the lists of its terms, each moved back by the term's offset, from the rarest term of the segment on;
terms that a segment lacks end the search at once. A proximity match is a stretch of at most `near` words that holds
all terms of a phrase in any order.

Scale: segments are searched where they lie, nothing of the corpus is shuffled but one small row per document. The
test set goes to the workers in parts of about `TEST_BYTES` of text, one job per part, so what a worker holds does not
grow with it; the parts' answers are merged per document.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, compared by 64-bit hashes.

Defined cases: a null or empty text has no words; a test item without words is never found; an item with fewer words
than a window is one window. Items without id still mark words but are not listed. Rows with equal ids are separate
documents, or texts of one item. Other columns are not read. Empty tables on either side give no hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import TEXT_ROWS, materialise
from staymill.llm.words import ALNUM, chunks, find, runs, split_words, text_buffer

TEST_BYTES = 8 << 20
GAP = 64  # places left free between documents; the widest proximity match
_INDEX = "range int, seq int, doc_id array<long>, bounds binary, terms binary, lists binary, places binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for seq, chunk in enumerate(chunks(batches)):
        words = split_words(*text_buffer(chunk.column("text")), ALNUM)
        hashes, bounds = words.hash, words.bounds
        del words  # places of bytes are not needed any more
        gaps = np.repeat((GAP * np.arange(chunk.num_rows)).astype(np.uint32), np.diff(bounds))
        place = np.arange(len(hashes), dtype=np.uint32) + gaps
        order = np.argsort(hashes, kind="stable")
        keys = hashes[order]
        lists = runs(keys)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seq], pa.int32()),
                pa.array([chunk.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([bounds.astype(np.int64).tobytes()], pa.binary()),
                pa.array([keys[lists].tobytes()], pa.binary()), pa.array([np.append(lists, len(keys)).astype(np.uint32).tobytes()], pa.binary()),
                pa.array([place[order].tobytes()], pa.binary()),
            ],
            names=["range", "seq", "doc_id", "bounds", "terms", "lists", "places"],
        )


def build_index(docs: DataFrame) -> DataFrame:
    """Positional postings of all words of `docs` (doc_id, text), written to the shared folder: one row per segment."""
    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_segments, _INDEX), "postings", batch_rows=TEXT_ROWS, codec="zstd")


class Phrases:
    """The distinct windows of a part of the test set: term hashes, and the items that hold each."""

    def __init__(self, items: list[int | None], texts: list[str | None], window: int):
        words = split_words(*text_buffer(pa.array(texts, pa.string())), ALNUM)
        holders: dict[tuple, set] = {}
        for item, a, b in zip(items, words.bounds, words.bounds[1:]):
            terms = words.hash[a:b].tolist()
            for k in range(max(1, len(terms) - window + 1) if terms else 0):
                holders.setdefault(tuple(terms[k : k + window]), set()).add(item)
        self.windows = list(holders)
        self.items = [sorted(i for i in held if i is not None) for held in holders.values()]
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.flat = np.array([t for w in self.windows for t in w], np.uint64)


def _near(lists: list[np.ndarray], span: int) -> np.ndarray:
    """First places of stretches of `span` places that hold a place of every list; the first list is the rarest."""
    places = lists[0]
    for other in lists[1:]:
        at = np.searchsorted(other, places - span + 1)
        places = places[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= places + span - 1)]
        if not len(places):
            return places
    starts = np.unique(places[:, None] - np.arange(span)[None, :])
    for other in lists:
        at = np.searchsorted(other, starts)
        starts = starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= starts + span - 1)]
    return starts


def _search(batches: Iterator[pa.RecordBatch], part, near: int) -> Iterator[pa.RecordBatch]:
    phrases: Phrases = part.value
    for batch in batches:
        for i in range(batch.num_rows):  # one segment at a time leaves the others in their buffer
            row = batch.slice(i, 1).to_pylist()[0]
            bounds = np.frombuffer(row["bounds"], np.int64)
            terms, lists = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["lists"], np.uint32).astype(np.int64)
            places = np.frombuffer(row["places"], np.uint32)
            docs = len(row["doc_id"])
            base = bounds[:-1] + GAP * np.arange(docs)  # place of each document's first word
            at = find(terms, phrases.flat)
            missing = np.concatenate([[0], np.cumsum(at < 0)])
            whole = np.flatnonzero(missing[phrases.first[1:]] == missing[phrases.first[:-1]])
            hits: dict[int, list[np.ndarray]] = {}
            items: dict[int, set] = {}
            close: dict[int, set] = {}
            for w in whole.tolist():
                ts = at[phrases.first[w] : phrases.first[w + 1]]
                order = np.argsort(lists[ts + 1] - lists[ts], kind="stable")  # from the rarest term on
                posting = {int(t): places[lists[t] : lists[t + 1]].astype(np.int64) for t in ts}
                found = posting[int(ts[order[0]])] - order[0]
                for k in order[1:]:
                    other = posting[int(ts[k])]
                    spot = np.minimum(np.searchsorted(other, found + k), len(other) - 1)
                    found = found[other[spot] == found + k]
                    if not len(found):
                        break
                for p in found.tolist():
                    d = int(np.searchsorted(base, p, "right")) - 1
                    hits.setdefault(d, []).append(np.arange(p, p + len(ts)) - base[d])
                    items.setdefault(d, set()).update(phrases.items[w])
                if near:
                    distinct = [posting[t] for t in dict.fromkeys(int(ts[k]) for k in order)]
                    for d in np.unique(np.searchsorted(base, _near(distinct, near) + near - 1, "right") - 1).tolist():
                        close.setdefault(d, set()).update(phrases.items[w])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["range"]] * docs, pa.int32()), pa.array([row["seq"]] * docs, pa.int32()), pa.array(range(docs), pa.int32()),
                    pa.array(row["doc_id"], pa.int64()), pa.array(np.diff(bounds), pa.int64()),
                    pa.array([np.unique(np.concatenate(hits[d])).tolist() if d in hits else [] for d in range(docs)], pa.list_(pa.int64())),
                    pa.array([sorted(items.get(d, ())) for d in range(docs)], pa.list_(pa.int64())),
                    pa.array([sorted(close.get(d, ())) for d in range(docs)], pa.list_(pa.int64())),
                ],
                names=["range", "seq", "nth", "doc_id", "n_words", "hit", "items", "near_items"],
            )


def match(index: DataFrame, tests: DataFrame, window: int = 10, near: int = 0) -> DataFrame:
    """Per document: (doc_id, n_words, hit, items, near_items): places of hit words, items with an exact or a near match.

    `tests` has (item_id, text). `near` is the span of proximity matches in words; 0 leaves them out."""
    if not 0 <= near <= GAP:
        raise ValueError(f"near must lie between 0 and {GAP}")
    spark = index.sparkSession
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // TEST_BYTES))
    keyed = tests.select(F.col("item_id").cast("long").alias("item_id"), "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("part"))
    found = None
    for part in range(parts):
        rows = keyed.where(F.col("part") == part).collect()
        held = spark.sparkContext.broadcast(Phrases([r["item_id"] for r in rows], [r["text"] for r in rows], window))
        got = index.mapInArrow(
            lambda it, held=held: _search(it, held, near),
            "range int, seq int, nth int, doc_id long, n_words long, hit array<long>, items array<long>, near_items array<long>",
        )
        found = got if found is None else found.unionByName(got)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("range", "seq", "nth").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), union("hit"), union("items"), union("near_items")
    )


def digest(found: DataFrame) -> DataFrame:
    listed = lambda c: F.sha2(F.array_join(F.array_sort(F.transform(c, lambda i: i.cast("string"))), ","), 256)
    n_hit = F.size("hit").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        listed("items").alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"), listed("near_items").alias("near_items_sha256"),
    )
