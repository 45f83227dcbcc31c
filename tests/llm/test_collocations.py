"""Phrases against a plain count: any block size, long texts, nulls, ties, four words."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staymill.llm import collocations as C

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, max_words, min_count, keep_share, top):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in range(1, max_words + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = []
    for lang in sizes:
        found = []
        candidates = {p: f for (g, p), f in counts.items() if g == lang and len(p) > 1 and f >= min_count}
        for p, a in candidates.items():
            inside = any(100 * f >= keep_share * a for q, f in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not inside:
                cuts = [(1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
                score, _, l, r = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def _texts(n=60, seed=1):
    rng = random.Random(seed)
    words = ["The", "the", "old", "Ünder", "x", "né", "a\x00b", "—"]
    return [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(rng.randint(0, 120)))) for _ in range(n)]


ROWS = _texts() + [("en", None), ("en", ""), (None, None), ("fr", "one two three " * 30), ("fr", "one two three " * 30), ("fr", "one two, three. one two")]


@pytest.mark.parametrize("options", [(3, 10, 50, 2000), (2, 3, 50, 2000), (4, 5, 80, 2000), (3, 5, 50, 4)])
def test_equals_a_plain_count(spark, options):
    docs = spark.createDataFrame(ROWS, "lang string, text string").withColumns({c: F.lit("clash") for c in ("key", "f", "block", "phrase", "n")}).repartition(4)
    assert sorted(map(tuple, C.mine(docs, *options).collect())) == _brute(ROWS, *options)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "BLOCK_BYTES", 100)
    text = "some words of a piece, and more; " * 40 + "x" * 1000 + " end. tail"
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "text": [text, "short one"]})
    parts = [bytes(data[offsets[i] : offsets[i + 1]]).decode() for langs, data, offsets in C._segments(iter([batch])) for i in range(len(langs))]
    assert "".join(parts) == text + "short one" and max(map(len, parts)) < 1200 and len(parts) > 8
    assert all(p[-1] in ",;." for p in parts[:-2])


def test_packed_values_come_back():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    for k in (keys, keys[:0], np.array([2**64 - 1], np.uint64)):
        assert (C._unpack_keys(C._pack_keys(k)) == k).all() and len(C._unpack_keys(C._pack_keys(k))) == len(k)
    for values in ([], [0], [255, 256], [1, 70_000, 2**40]):
        assert C._unpack(C._pack(np.array(values, np.int64))).tolist() == values
        assert C._unpack_places(C._pack_places(np.array(values, np.int64))).tolist() == values


def test_many_parts_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_KEYS", 50)  # on the driver: the number of parts
    docs = spark.createDataFrame(ROWS, "lang string, text string").repartition(7)
    assert sorted(map(tuple, C.mine(docs, 3, 5, 50, 2000).collect())) == _brute(ROWS, 3, 5, 50, 2000)


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(1, "en", "p q", 10**12 + 7, [10**13 + 3], [10**12 + 9]), (2, "en", "r s", 3 * 10**14, [3 * 10**14], [3 * 10**14])]
    df = spark.createDataFrame(rows, "key long, lang string, phrase string, f long, firsts array<long>, rests array<long>")
    got = {r.key: r.score for r in C._scored(df, 2).collect()}
    assert got == {k: 1000000 * f * f // (l[0] * r[0]) for k, _, _, f, l, r in rows}


def test_empty_tables(spark):
    assert C.mine(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert C.mine(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0
