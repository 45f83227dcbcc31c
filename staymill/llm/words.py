"""Words of many texts at once: hashes and places straight from the Arrow buffers, without a Python string per word.

Words are runs of bytes of a class, A-Z counted as a-z. All classes used here put every byte from 0x80 on
into words, so UTF-8 characters are never cut."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # text handled at once; bounds the memory of a task whatever the size of a batch


def _class(separators: list[int]) -> np.ndarray:
    inside = np.ones(256, bool)
    inside[separators] = False
    return inside


#: `[^\x20\x09-\x0D]+`
SPACED = _class([0x20, *range(0x09, 0x0E)])
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
ALNUM = _class([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_EXACT = _BYTE.copy()
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 17  # bytes hashed at once


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    hash: np.ndarray  # uint64 for each word
    start: np.ndarray  # first byte in `data`
    end: np.ndarray  # one after the last
    bounds: np.ndarray  # word i of text t: bounds[t] <= i < bounds[t + 1]
    data: np.ndarray  # the bytes of all texts


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of each span of bytes; with `fold`, A-Z count as a-z.

    Every byte is mixed with its place in the span before the sum, so no arrangement of equal bytes cancels out. Blocks
    bound what is held at once, however long a span is."""
    table = _BYTE if fold else _EXACT
    size = end - start
    total = size.astype(np.uint64)
    edge = np.concatenate([[0], np.cumsum(size)])
    joined = data[start[0] : end[-1]] if len(start) and (start[1:] == end[:-1]).all() else None  # spans without gaps
    for low in range(0, int(edge[-1]), _BLOCK):
        high = min(low + _BLOCK, int(edge[-1]))
        a, b = int(np.searchsorted(edge, low, "right")) - 1, int(np.searchsorted(edge, high, "left"))
        cut = np.clip(edge[a : b + 1], low, high)
        here = np.diff(cut)
        place = np.arange(low, high) - np.repeat(edge[a:b], here)
        raw = data[np.repeat(start[a:b], here) + place] if joined is None else joined[low:high]
        x = mix(table[raw] + place.astype(np.uint64) * _BASE)
        full = np.flatnonzero(here)
        part = total[a:b]
        part[full] += np.add.reduceat(x, (cut[:-1] - low)[full])
    return mix(total)


def split_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Words of the texts data[offsets[t]:offsets[t + 1]]."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64), data)
    word = inside[data]
    fresh = word.copy()
    fresh[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text begins a word of its own
    fresh[edge] = word[edge]
    before = edge[edge > 0] - 1
    last[before] = word[before]
    start, end = np.flatnonzero(fresh), np.flatnonzero(last) + 1
    return Words(hash_spans(data, start, end), start, end, np.searchsorted(start, offsets), data)


def hash_word(word: str, inside: np.ndarray = SPACED) -> int:
    raw = np.frombuffer(word.encode("utf-8", "surrogatepass"), np.uint8)
    return int(split_words(raw, np.array([0, len(raw)]), inside).hash[0])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `limit` bytes of text; a longer text makes a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(text))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
            yield batch.slice(row, stop - row)
            row = stop
        pa.default_memory_pool().release_unused()  # workers live on after their task


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """First place of every run of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1])


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key, or -1."""
    if not len(sorted_keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, at, -1)
