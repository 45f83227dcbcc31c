"""Phrase collocations by set-oriented mining: occurrence relations, merge-joined by piece and adjacent position.

The relation of length 1 holds every word with its place; places run on within a piece and skip one between pieces.
Per length: count the groups, keep the frequent ones, semi-join the relation with them, and merge-join what is left with
itself one place further for the next length (two phrases that overlap in all but one word make one longer phrase). A
phrase is known by the keys of its first and its last part, and these links also give the counts of all its cuts.

A relation is written block by block, a block being some megabytes of text: the vocabulary that is left in it, and for
each occurrence its code and its place, all packed. Both sides of a merge-join always lie in one block, so occurrences
are never dealt out by phrase. For the group-count a block deals out its sorted
keys, once each; back come two bits a key: is it frequent, and has this block to spell it out.

Scale: the number of parts of a group-count grows with the keys, so that a task sums some millions of them; parts that a
block has nothing for are left out, and a very common phrase is one key per block. Texts longer than a block are cut
between pieces, so a task holds a few blocks whatever the texts are. Ranking cuts each language into hashed parts first,
whose best rows alone meet.

Words are told apart by 64-bit hashes of language and word, phrases by 64-bit hashes of their two parts.

Defined cases: a null language counts as `und`, a null or empty text has no words. Ties in score and count go by phrase.
Repeated rows count each. Other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staymill.functions.session import materialise
from staymill.llm.words import chunks, mix, runs, split_words, text_buffer

BLOCK_BYTES = 4 << 20
PART_KEYS = 1_000_000  # keys of all blocks that one task sums, about
RANK_PARTS = 256  # parts of a language that are ranked apart first
NO_LANG = "und"

_SEPARATORS = np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8)
_BREAK = np.zeros(256, bool)
_BREAK[_SEPARATORS] = True
_INSIDE = ~_BREAK
_INSIDE[[0x20, 0x09]] = False
_NO_SPACE = np.ones(256, bool)
_NO_SPACE[0x20] = False

#: A block's occurrences: vocabulary (spelled words, or keys of frequent phrases), the code of each occurrence, its place.
_RELATION = (
    "block long, size long, words binary, langs binary, vocabulary binary, codes binary, places binary, all_langs array<string>, all_counts array<long>, "
    "told array<struct<key: long, head: long, tail: long, phrase: string, lang: string>>"
)
_SHARES = "part int, block long, keys binary, counts binary"
_FOUND = "part int, block long, size int, mask binary, tells binary, keys array<long>, counts array<long>"


# --- Blocks ---------------------------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """Laid down byte by byte, so that empty upper bytes cost nothing."""
    return _squeeze(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def _from_planes(packed: bytes, kind: np.dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack(values: np.ndarray) -> bytes:
    small = values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
    return bytes([small.itemsize]) + _planes(small)


def _unpack(packed: bytes) -> np.ndarray:
    return _from_planes(packed[1:], np.dtype(f"u{packed[0]}")).astype(np.int64)


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _pack_places(places: np.ndarray) -> bytes:
    return _pack(np.diff(places, prepend=0))


def _unpack_places(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed))


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as steps."""
    return _planes(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(packed, np.dtype("u8")), dtype=np.uint64)


def _word_keys(hashes: np.ndarray, langs: list[str], lang: np.ndarray) -> np.ndarray:
    salt = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in langs], np.uint64)
    return mix(hashes + salt[lang])


def _by_count(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(old codes from the most frequent on, new codes): small numbers for what is common pack best."""
    order = np.argsort(-np.bincount(codes, minlength=size), kind="stable")
    new = np.empty(size, np.int64)
    new[order] = np.arange(size)
    return order, new[codes]


def _key(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    return mix(heads * np.uint64(0x9E3779B97F4A7C15) + mix(tails + np.uint64(0x632BE59BD9B4E019)))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(languages, bytes, offsets) of some texts; a text longer than a block comes in parts that end between pieces."""
    for chunk in chunks(batches, limit=BLOCK_BYTES):
        data, offsets = text_buffer(chunk.column("text"))
        langs = chunk.column("lang").to_pylist()
        if len(langs) > 1 or len(data) <= 2 * BLOCK_BYTES:
            yield langs, data, offsets
            continue
        at = 0
        while at < len(data):
            end = len(data)
            for low in range(at + BLOCK_BYTES, len(data), BLOCK_BYTES):  # the first piece that ends after a block's length
                ends = np.flatnonzero(_BREAK[data[low : low + BLOCK_BYTES]])
                if len(ends):
                    end = low + int(ends[0]) + 1
                    break
            yield langs, data[at:end], np.array([0, end - at])
            at = end


def _relation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length 1: the words of each block with their places."""
    for seq, (langs, data, offsets) in enumerate(_segments(batches)):
        words = split_words(data, offsets, _INSIDE)
        n = len(words.hash)
        if not n:
            continue
        breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
        fresh = np.zeros(n, bool)
        fresh[1:] = breaks[words.start[1:]] != breaks[words.end[:-1]]
        doc = np.repeat(np.arange(len(langs)), np.diff(words.bounds))
        fresh[1:] |= doc[1:] != doc[:-1]
        places = np.arange(n) + np.cumsum(fresh)
        kinds = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
        lang = np.array([kinds[x] for x in langs])
        _, first, codes = np.unique(_word_keys(words.hash, list(kinds), lang[doc]), return_index=True, return_inverse=True)
        order, codes = _by_count(codes, len(first))
        first = first[order]
        spelled = b" ".join(data[a:b].tobytes().lower() for a, b in zip(words.start[first].tolist(), words.end[first].tolist()))  # no word holds a space
        yield _row(
            TaskContext.get().partitionId() << 32 | seq, len(first), codes, places, words=_squeeze(spelled), langs=_pack(lang[doc[first]]),
            all_langs=list(kinds), all_counts=np.bincount(lang, np.diff(words.bounds)).astype(np.int64),
        )


def _told(key, head=None, tail=None, phrase=None, lang=None) -> pa.Array:
    """Phrases that a block spells out, as one list."""
    n = len(key)
    number = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(x.view(np.int64))
    text = lambda x: pa.nulls(n, pa.string()) if x is None else pa.array(x, pa.string())
    rows = pa.StructArray.from_arrays([number(key), number(head), number(tail), text(phrase), text(lang)], names=["key", "head", "tail", "phrase", "lang"])
    return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows)


def _row(block: int, size: int, codes, places, words=b"", langs=b"", vocabulary=b"", all_langs=(), all_counts=(), told=None) -> pa.RecordBatch:
    binary = (words, langs, vocabulary, _pack(codes), _pack_places(places))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()), pa.array([size], pa.int64()), *[pa.array([x], pa.binary()) for x in binary], pa.array([list(all_langs)], pa.list_(pa.string())),
            pa.array([list(all_counts)], pa.list_(pa.int64())), _told(np.zeros(0, np.uint64)) if told is None else told,
        ],
        names=["block", "size", "words", "langs", "vocabulary", "codes", "places", "all_langs", "all_counts", "told"],
    )


class _Block:
    """The distinct phrases of a block and their occurrences: its words, or the merge-join of its stored occurrences with
    themselves one place further."""

    def __init__(self, row: dict):
        codes, places = _unpack(row["codes"]), _unpack_places(row["places"])
        self.pairs = not row["words"]
        if self.pairs:
            vocabulary = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["vocabulary"]), np.uint64)
            a, b = _merge_join(places, places)
            pair, self.codes = np.unique(codes[a] * len(vocabulary) + codes[b], return_inverse=True)
            self.places = places[a]
            self.heads, self.tails = vocabulary[pair // len(vocabulary)], vocabulary[pair % len(vocabulary)]
            self.keys = _key(self.heads, self.tails)
        else:
            self.codes, self.places = codes, places
            self.spelled = zstandard.ZstdDecompressor().decompress(row["words"])
            self.lang, self.langs = _unpack(row["langs"]), row["all_langs"]
            data = np.frombuffer(self.spelled, np.uint8)
            self.keys = _word_keys(split_words(data, np.array([0, len(data)]), _NO_SPACE).hash, self.langs, self.lang)
        self.counts = np.bincount(self.codes, minlength=len(self.keys))
        self.order = np.argsort(self.keys)

    def told(self, at: np.ndarray) -> pa.Array:
        if self.pairs:
            return _told(self.keys[at], self.heads[at], self.tails[at])
        words = self.spelled.split(b" ")
        return _told(self.keys[at], phrase=[words[i].decode("utf-8", "replace") for i in at.tolist()], lang=[self.langs[i] for i in self.lang[at].tolist()])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _shares(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Keys and counts of each block, cut into parts by the upper bits of the keys; empty parts are left out."""
    for row in _rows(batches):
        block = _Block(row)
        keys, counts = block.keys[block.order], block.counts[block.order]
        part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        first = runs(part)
        ends = np.append(first[1:], len(part))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part[first], pa.int32()), pa.array([row["block"]] * len(first), pa.int64()),
                pa.array([_pack_keys(keys[a:b]) for a, b in zip(first, ends)], pa.binary()), pa.array([_pack(counts[a:b]) for a, b in zip(first, ends)], pa.binary()),
            ],
            names=["part", "block", "keys", "counts"],
        )


def _count(pdf: pd.DataFrame, min_count: int) -> pd.DataFrame:
    """One part of all blocks: sums, and for each block which of its keys are frequent and which it has to spell out."""
    pdf = pdf.sort_values("block", ignore_index=True)
    keys = [_unpack_keys(k) for k in pdf["keys"]]
    edge = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    kinds, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.zeros(len(kinds), np.int64)
    np.add.at(total, inverse, np.concatenate([_unpack(c) for c in pdf["counts"]]))
    good = total >= min_count
    mask, tells = good[inverse], np.zeros(len(inverse), bool)
    tells[first[good]] = True
    cut = lambda flags: [np.packbits(flags[a:b]).tobytes() for a, b in zip(edge, edge[1:])] + [b""]
    none = [np.zeros(0, np.int64)] * len(pdf)
    return pd.DataFrame({
        "part": pdf["part"][0], "block": [*pdf["block"], -1], "size": [*np.diff(edge), 0], "mask": cut(mask), "tells": cut(tells),
        "keys": [*none, kinds[good].view(np.int64)], "counts": [*none, total[good]],
    })


def _merge_join(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two sorted place lists of which the right one stands a place further."""
    at = np.minimum(np.searchsorted(right, left + 1), max(len(right) - 1, 0))
    met = np.flatnonzero(right[at] == left + 1) if len(right) else np.zeros(0, np.int64)
    return met, at[met]


def _flags(masks: list[dict], which: str) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(m[which], np.uint8), count=m["size"]) for m in sorted(masks, key=lambda m: m["part"])]
    return np.concatenate(parts).astype(bool)


def _longer(batches: Iterator[pa.RecordBatch], extend: bool) -> Iterator[pa.RecordBatch]:
    """The frequent occurrences of a block, and the phrases that it has to spell out."""
    none = np.zeros(0, np.int64)
    for row in _rows(batches):
        block = _Block(row)
        told = block.told(block.order[_flags(row["masks"], "tells")])
        if not extend:
            yield _row(row["block"], 0, none, none, told=told)
            continue
        keep = np.zeros(len(block.keys), bool)
        keep[block.order] = _flags(row["masks"], "mask")
        here = keep[block.codes]
        order, codes = _by_count((np.cumsum(keep) - 1)[block.codes[here]], int(keep.sum()))
        places = block.places[here]
        size = len(_merge_join(places, places)[0])  # at least as many as distinct phrases
        yield _row(row["block"], size, codes, places, vocabulary=_squeeze(block.keys[keep][order].tobytes()), told=told)


# --- Mining -----------------------------------------------------------------------


def _frequent(relation: DataFrame, min_count: int) -> DataFrame:
    """Sums of all keys by parts of about `PART_KEYS` keys: rows of flags for the blocks, and of the frequent keys (block -1)."""
    keys = relation.agg(F.sum("size")).first()[0] or 0
    bits = max(0, int(keys // PART_KEYS).bit_length())
    packed = relation.where("size > 0").select("block", "words", "langs", "vocabulary", "codes", "places", "all_langs")
    shares = packed.mapInArrow(lambda it: _shares(it, bits), _SHARES)
    return materialise(shares.groupBy("part").applyInPandas(lambda pdf: _count(pdf, min_count), _FOUND), "found")


def _extend(relation: DataFrame, found: DataFrame, extend: bool) -> DataFrame:
    """The semi-joined relation, and in `told` its frequent phrases."""
    masks = found.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("part", "size", "mask", "tells")).alias("masks"))
    rows = relation.where("size > 0").select("block", "words", "langs", "vocabulary", "codes", "places", "all_langs")
    joined = rows.join(masks.hint("merge"), "block")  # masks grow with the corpus
    return materialise(joined.mapInArrow(lambda it: _longer(it, extend), _RELATION), "phrases")


def frequent_phrases(docs: DataFrame, max_words: int, min_count: int) -> tuple[list[DataFrame], DataFrame]:
    """(tables of the phrases of 1, 2, ... words with at least `min_count` occurrences, words per language).

    Columns: key, head, tail (keys of the first and last part; null for words), lang, phrase, last, f, firsts, rests: counts
    of the phrase's beginnings and endings of 1, 2, ... words."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    relation = materialise(rows.mapInArrow(_relation, _RELATION), "words")
    sizes = relation.select(F.inline(F.arrays_zip("all_langs", "all_counts"))).toDF("lang", "n").groupBy("lang").agg(F.sum("n").alias("n"))
    none = F.array().cast("array<bigint>")
    tables: list[DataFrame] = []
    for length in range(1, max_words + 1):
        found = _frequent(relation, min_count)
        relation = _extend(relation, found, extend=length < max_words)
        counts = found.where("block = -1").select(F.inline(F.arrays_zip("keys", "counts"))).toDF("key", "f")
        spelled = relation.select(F.inline("told")).join(counts, "key")
        if length == 1:
            table = spelled.select("key", "head", "tail", "lang", "phrase", F.col("phrase").alias("last"), "f", none.alias("firsts"), none.alias("rests"))
        else:
            first = tables[-1].select(F.col("key").alias("head"), "lang", F.col("phrase").alias("_begin"), F.concat("firsts", F.array("f")).alias("firsts"))
            rest = tables[-1].select(F.col("key").alias("tail"), "last", F.concat("rests", F.array("f")).alias("rests"))
            joined = spelled.drop("phrase", "lang").join(first, "head").join(rest, "tail")
            table = joined.select("key", "head", "tail", "lang", F.concat_ws(" ", "_begin", "last").alias("phrase"), "last", "f", "firsts", "rests")
        tables.append(materialise(table, "frequent"))
    return tables, sizes


def _scored(table: DataFrame, words: int) -> DataFrame:
    """Score of the lowest cut; products are decimals of 38 digits, so counts up to 10^15 stay exact."""
    a = F.col("f").cast("decimal(15,0)")
    cuts = []
    for k in range(1, words):
        l, r = F.col("firsts")[k - 1], F.col("rests")[words - k - 1]
        score = F.expr(f"(cast(1000000 as decimal(7,0)) * cast(f as decimal(15,0)) * cast(f as decimal(15,0))) div (cast(firsts[{k - 1}] as decimal(15,0)) * cast(rests[{words - k - 1}] as decimal(15,0)))")
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    best = F.array_min(F.array(*cuts))
    return table.select("key", "lang", "phrase", F.col("f").alias("a"), best.alias("_cut")).select("key", "lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def mine(docs: DataFrame, max_words: int = 3, min_count: int = 10, keep_share: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to `max_words` words of each language.

    A phrase is dropped if one that is a word longer, and contains it, has `keep_share` per cent of its occurrences. Any
    longer one that has as many contains such a phrase itself, so one step is enough."""
    tables, sizes = frequent_phrases(docs, max_words, min_count)
    found = None
    for words in range(2, max_words + 1):
        scored = _scored(tables[words - 1], words)
        if words < max_words:
            longer = tables[words]
            inside = longer.select(F.col("head").alias("key"), "f").unionByName(longer.select(F.col("tail").alias("key"), "f"))
            most = inside.groupBy("key").agg(F.max("f").alias("_most"))
            scored = scored.join(most, "key", "left").where(F.coalesce(F.col("_most"), F.lit(0)) * 100 < F.col("a") * keep_share).drop("_most")
        found = scored if found is None else found.unionByName(scored)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod("key", F.lit(RANK_PARTS))
    first = found.withColumn("_r", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("_r") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT lang, k, phrase, a, cut, array_to_string(w[:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest FROM c, range(1, 3) t(cut) WHERE cut < k),
scored AS (
  SELECT c.lang, c.k, c.phrase, a, cut, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = first JOIN f y ON y.lang = c.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(w[:2], ' ') AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:], ' '), a FROM c WHERE k = 3),
most AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN most m ON b.lang = m.lang AND b.phrase = m.phrase WHERE 100 * coalesce(most, 0) < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
