"""Token ids of a corpus as wavelet matrices, one compressed file image per shard.

Documents are put in ascending order of id by a range shuffle, encoded with a public tokenizer, and each document is
closed with an end id. A task cuts its range into shards of about `SHARD_TOKENS` ids (a longer document makes a longer
shard) and writes one image per shard through Spark into the shared folder. An image holds the document table, the
bit-planes and a rank directory; from it alone `WaveletMatrix` gives single ids (`access`), counts (`rank`, `count`),
places (`select`) and all ids (`decode`).

Scale: one shuffle of the texts; a shard is the unit of memory. The place of a range in the corpus comes from one total
per range. Equal doc_ids are spread by a hash of their text, so no id can fill a range.

Defined cases: a null text is an empty one (its only id is the end id); rows without doc_id come first; rows with equal
doc_id follow each other in the order of a hash of their text; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import TEXT_ROWS, arrow_rows, scratch_path
from staymill.llm.words import chunks, hash_spans, runs, text_buffer

SHARD_TOKENS = 1 << 20
CACHE_UNITS = 500_000  # about 17 MB in a worker
LONG_UNIT = 64  # ids; longer units do not stay when there are too many ids
END = 0
_MAGIC = b"WAVELET1"
_RANK_BITS = 512
_SHARD = "range long, seq long, base long, n long, image binary"


class WaveletMatrix:
    """Bit-planes from the most significant digit down; each plane orders the ids for the next, zeros first."""

    def __init__(self, n: int, planes: np.ndarray, zeros: np.ndarray, ranks: np.ndarray, doc_ids: np.ndarray, known: np.ndarray, starts: np.ndarray):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks
        self.doc_ids, self.known, self.starts = doc_ids, known, starts

    @classmethod
    def build(cls, ids: np.ndarray, doc_ids: np.ndarray, known: np.ndarray, starts: np.ndarray) -> WaveletMatrix:
        n, levels = len(ids), max(1, int(ids.max()).bit_length()) if len(ids) else 1
        words = -(-n // _RANK_BITS) * (_RANK_BITS // 64)
        planes, zeros = np.zeros((levels, words * 8), np.uint8), np.zeros(levels, np.int64)
        for level in range(levels):
            bit = (ids & ids.dtype.type(1 << (levels - 1 - level))) != 0
            packed = np.packbits(bit, bitorder="little")
            planes[level, : len(packed)] = packed
            low = np.compress(~bit, ids)
            zeros[level] = len(low)
            ids = np.concatenate([low, np.compress(bit, ids)])
        planes = planes.view(np.uint64)
        ones = np.bitwise_count(planes).reshape(levels, -1, _RANK_BITS // 64).sum(axis=2, dtype=np.int64)
        ranks = np.zeros((levels, ones.shape[1] + 1), np.int64)
        np.cumsum(ones, axis=1, out=ranks[:, 1:])
        return cls(n, planes, zeros, ranks, doc_ids, known, starts)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.planes), len(self.doc_ids)], np.int64)
        parts = [head, self.zeros, self.doc_ids, self.starts, self.known.astype(np.int64), self.planes, self.ranks]
        return _MAGIC + zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        if raw[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not a wavelet image")
        flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[len(_MAGIC) :]), np.int64)
        n, levels, docs = (int(x) for x in flat[:3])
        blocks = -(-n // _RANK_BITS)
        sizes = [levels, docs, docs + 1, docs, levels * blocks * (_RANK_BITS // 64), levels * (blocks + 1)]
        zeros, doc_ids, starts, known, planes, ranks = np.split(flat[3:], np.cumsum(sizes)[:-1])
        return cls(n, planes.view(np.uint64).reshape(levels, -1), zeros, ranks.reshape(levels, -1), doc_ids, known.astype(bool), starts)

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before place i."""
        block, w = i // _RANK_BITS, i // 64
        count = int(self.ranks[level, block]) + int(np.bitwise_count(self.planes[level, block * (_RANK_BITS // 64) : w]).sum())
        return count + (int(self.planes[level, w]) & ((1 << (i % 64)) - 1)).bit_count() if i % 64 else count

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i // 64]) >> (i % 64) & 1

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = int(self.zeros[level]) + ones if bit else i - ones
        return value

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of a token in [low, high) stand after the last plane."""
        levels = len(self.planes)
        if token < 0 or token >> levels:
            return 0, 0
        for level in range(levels):
            a, b = self._ones(level, low), self._ones(level, high)
            if token >> (levels - 1 - level) & 1:
                low, high = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def rank(self, token: int, i: int) -> int:
        """Occurrences before place i."""
        return self.count(token, 0, i)

    def select(self, token: int, k: int) -> int:
        """Place of occurrence k, counted from 0; -1 if there are fewer."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= k < high - low:
            return -1
        i, levels = low + k, len(self.planes)
        for level in reversed(range(levels)):
            bit = token >> (levels - 1 - level) & 1
            want = i - int(self.zeros[level]) if bit else i
            a, b = 0, self.n - 1
            while a < b:  # the place whose digit is the one asked for and has `want` like it before
                mid = (a + b) // 2
                ones = self._ones(level, mid + 1)
                if (ones if bit else mid + 1 - ones) > want:
                    b = mid
                else:
                    a = mid + 1
            i = a
        return i

    def decode(self) -> np.ndarray:
        levels = len(self.planes)
        ids = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for level in reversed(range(levels)):
            bit = np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").view(bool)
            before, z = np.empty_like(ids), int(self.zeros[level])
            before[np.flatnonzero(~bit)] = ids[:z]
            before[np.flatnonzero(bit)] = ids[z:]
            ids = before | (bit.astype(ids.dtype) << ids.dtype.type(levels - 1 - level))
        return ids


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_BLANK = _bytes((0x20, 0x20), (0x0A, 0x0A))
_PUNCT = _bytes((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_PLAIN = _bytes((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_ODD = _bytes((0x09, 0x09), (0x0B, 0x0D), (0x1C, 0x1F))
_KIND = _BLANK + 2 * _PUNCT.astype(np.uint8) + 4 * _PLAIN.astype(np.uint8) + 8 * _ODD.astype(np.uint8)
# White space beyond ASCII, as UTF-8.
_WIDE = {2: [0xC285, 0xC2A0], 3: [0xE19A80, 0xE1A08E, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]}


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    """The spans as strings, all at once."""
    stop = np.cumsum(end - start)
    raw = data[np.repeat(start - (stop - (end - start)), end - start) + np.arange(stop[-1])]
    spans = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(0, stop)), pa.py_buffer(raw))
    try:
        return spans.to_pylist()
    except UnicodeDecodeError:  # bytes that are no UTF-8
        return [b.decode("utf-8", "replace") for b in spans.view(pa.large_binary()).to_pylist()]


class Units:
    """Ids of the units met so far, by the 64-bit hash of the unit. Beyond `CACHE_UNITS`, or 16 times as many ids, half as many
    stay: those that occur in most chunks, late ones counting more."""

    def __init__(self, dtype: np.dtype):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.float32)  # by slot
        self.first, self.flat = np.zeros(1, np.int64), np.zeros(0, dtype)

    def shrink(self) -> None:
        if len(self.keys) <= CACHE_UNITS and len(self.flat) <= 16 * CACHE_UNITS:
            return
        length = np.diff(self.first)
        kept = np.flatnonzero(length <= LONG_UNIT)  # slots
        if len(kept) > CACHE_UNITS // 2:
            kept = np.sort(kept[np.argpartition(self.uses[kept], -(CACHE_UNITS // 2))[-(CACHE_UNITS // 2) :]])
        stays = np.zeros(len(length), bool)
        stays[kept] = True
        self.flat = self.flat[np.repeat(stays, length)]
        self.first = np.append(0, np.cumsum(length[kept]))
        place = (np.cumsum(stays) - 1).astype(np.int32)
        here = stays[self.slots]
        self.keys, self.slots = self.keys[here], place[self.slots[here]]
        self.uses = self.uses[kept] / 2

    def add(self, at: np.ndarray, keys: np.ndarray, ids: list[list[int]]) -> None:
        """New units; `at` is their place among the sorted keys."""
        new = (np.arange(len(keys)) + len(self.uses)).astype(np.int32)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(g) for g in ids])])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), self.flat.dtype)])
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, new)
        self.uses = np.append(self.uses, np.zeros(len(keys), np.float32))


_kept: dict[str, Units] = {}  # by tokenizer: a worker's next task goes on with the units of the last one


class Encoder:
    """Encodes many texts at once. The tokenizer always cuts between another character and a blank or line feed, and
    between a letter or digit and punctuation, so texts are cut there into units; each distinct unit of a chunk is encoded
    once, and the common ones are kept in `Units`. Texts with other white space or with special tokens are encoded in one piece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        stat = os.stat(path)
        self.units = _kept.setdefault(f"{path} {stat.st_size} {stat.st_mtime_ns}", Units(self.dtype))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the ids of each unit are kept."""
        units = self.units
        units.shrink()
        hashes = hash_spans(data, start, end, fold=False)
        order = np.argsort(hashes)
        run = runs(hashes[order])
        one = order[run]  # any unit of each hash
        keys = hashes[one]
        at = np.searchsorted(units.keys, keys)
        fresh = np.flatnonzero(units.keys[np.minimum(at, len(units.keys) - 1)] != keys) if len(units.keys) else np.arange(len(keys))
        if len(fresh):
            units.add(at[fresh], keys[fresh], self._encode(_strings(data, start[one[fresh]], end[one[fresh]])))
            at = np.searchsorted(units.keys, keys)
        slot = units.slots[at]
        units.uses[slot] += 1
        found = np.empty(len(hashes), np.int32)
        found[order] = np.repeat(slot, np.diff(np.append(run, len(hashes))))
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts data[offsets[t]:offsets[t + 1]]."""
        n = len(data)
        if n == 0:
            return [np.zeros(0, self.dtype)] * (len(offsets) - 1)
        kind = _KIND[data]
        cut = np.zeros(n, bool)
        cut[0] = True
        now, last = kind[1:], kind[:-1]
        # punctuation after a letter or digit (4 to 2), a blank after anything else (1)
        cut[1:] = ((now & 1) > (last & 1)) | ((now & (last >> 1) & 2) != 0)
        # punctuation after the letters from À to ÿ
        lead = np.flatnonzero(data[:-2] == 0xC3)
        cut[lead[(kind[lead + 2] & 2 != 0) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)] + 2] = True
        cut[offsets[:-1][offsets[:-1] < n]] = True
        start = np.flatnonzero(cut)
        slot = self._slots(data, start, np.append(start[1:], n))
        first = self.units.first
        size = first[slot + 1] - first[slot]
        stop = np.cumsum(size)
        ids = self.units.flat[np.repeat(first[slot] - (stop - size), size) + np.arange(stop[-1])]
        edge = np.append(0, stop)[np.searchsorted(start, offsets)]
        out = np.split(ids, edge[1:-1])
        for t in self._whole(data, offsets, kind):
            out[t] = np.array(self._encode([data[offsets[t] : offsets[t + 1]].tobytes().decode("utf-8", "replace")])[0], self.dtype)
        return out

    def _whole(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> list[int]:
        places = [np.flatnonzero(kind & 8)]
        for width, codes in _WIDE.items():
            lead = np.flatnonzero(np.isin(data[: len(data) - width + 1], sorted({c >> 8 * (width - 1) for c in codes})))
            code = sum(data[lead + j].astype(np.int64) << 8 * (width - 1 - j) for j in range(width))
            places.append(lead[np.isin(code, codes)])
        raw = data.tobytes()
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                places.append(np.array([at]))
                at = raw.find(special, at + 1)
        return np.unique(np.searchsorted(offsets, np.concatenate(places), "right") - 1).tolist()


def _shards(batches: Iterator[pa.RecordBatch], path: str, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    enc = Encoder(path)  # the tokenizer ends with the task, as workers live on; its units stay, within their bound
    end = np.array([END], enc.dtype)
    docs: list[int | None] = []
    held: list[np.ndarray] = []
    n = seq = base = 0

    def image() -> pa.RecordBatch:
        known = np.array([d is not None for d in docs], bool)
        starts = np.concatenate([[0], np.cumsum([len(h) + 1 for h in held])]).astype(np.int64)
        ids = np.concatenate([x for h in held for x in (h, end)])
        blob = WaveletMatrix.build(ids, np.array([d or 0 for d in docs], np.int64), known, starts).to_bytes()
        return pa.RecordBatch.from_pydict({"range": [TaskContext.get().partitionId()], "seq": [seq], "base": [base], "n": [len(ids)], "image": [blob]})

    for chunk in chunks(batches):
        for doc, ids in zip(chunk.column("doc_id").to_pylist(), enc.encode(*text_buffer(chunk.column("text")))):
            docs.append(doc)
            held.append(ids)
            n += len(ids) + 1
            if n >= shard_tokens:
                yield image()
                seq, base = seq + 1, base + n
                docs, held, n = [], [], 0
    enc.units.shrink()
    if docs:
        yield image()


def write_shards(docs: DataFrame, tokenizer: str, path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Parquet under `path`: one row (range, seq, base, n, image) per shard; `base` counts from the start of the range."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        ordered.mapInArrow(lambda it: _shards(it, tokenizer, shard_tokens), _SHARD).write.parquet(path)


def _digest(batches: Iterator[pa.RecordBatch], first: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            m = WaveletMatrix.from_bytes(row["image"])
            wide = memoryview(m.decode().astype("<u4")).cast("B")
            cuts, at = m.starts.tolist(), first[row["range"]] + row["base"]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(m.doc_ids, pa.int64(), mask=~m.known),
                "start": pa.array(m.starts[:-1] + at, pa.int64()),
                "n_tokens": pa.array(np.diff(m.starts), pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
            })


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the images."""
    first, at = {}, 0
    for r in sorted(shards.groupBy("range").agg(F.sum("n").alias("n")).collect()):  # one row per range of the shuffle
        first[r["range"]] = at
        at += r["n"]
    return shards.mapInArrow(lambda it: _digest(it, first), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(docs: DataFrame, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards of `docs` to the shared folder and return them as read back."""
    path = scratch_path(docs.sparkSession, "wavelet")
    write_shards(docs, tokenizer, path, shard_tokens)
    return docs.sparkSession.read.schema(_SHARD).parquet(path)
