"""Exact top-k search by integer inner product over a bit-sliced index.

Every component of a vector is turned into the integer floor(scale * x). A block of the index keeps, for each
component and each binary digit, one bitmap over its rows. For a query the bitmaps are added up with carry-save
adders (AND, OR, XOR on whole bitmaps), which gives the scores of all rows of the block as bitmaps again. The best
k rows are picked from the most significant score bitmap downward; the rows that are still tied after the last
bitmap have equal scores, and the smallest ids among them fill the remaining places, so the result is exact.

Scale: index blocks hold about `BLOCK_ROWS` rows by a hash of the row, query groups about `QUERY_ROWS`. Every cell of
the grid blocks x groups is one row of a hash join on (block, group), so memory is bounded and cells spread evenly.
A cell sends on k rows per query at most. The work is queries x rows, as for any exact search.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without id take no part. A block
has as many slices as its widest component needs, so components of any size are scored; an integer beyond 64 bits
becomes the nearest end of that range, and so does a score when it is returned, but ranks follow the full score.
Shorter vectors count as filled up with zeros. Of several rows with one id the smallest vector stays, unless `every_row`
is set: then each of them is a candidate, and the results of several query rows with one id are ranked together. A query
never meets rows of its own id. An empty table gives an empty result. Columns besides the two named are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staymill.functions.session import materialise

BLOCK_ROWS = 32_768
QUERY_ROWS = 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1
WIDE = 40  # bytes of a score beyond 64 bits: products of 127 bits and far more dimensions than an array can have


def quantise(df: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """(id, v): integer components of the rows that can be scored."""
    fit = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fit).select(F.col(key).cast("long").alias("id"), whole.alias("v"))


def _matrix(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and the vectors of the rows, filled up with zeros."""
    pdf = pdf.sort_values("id", kind="stable")
    m = np.zeros((len(pdf), max(map(len, pdf["v"]), default=0)), np.int64)
    for row, v in zip(m, pdf["v"]):
        row[: len(v)] = v
    return pdf["id"].to_numpy(np.int64), m


def _index_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    ids, m = _matrix(pdf)
    low = int(m.min()) if m.size else 0
    u = m.astype(np.uint64) - np.uint64(low % (1 << 64))  # the spread of 64-bit integers fits 64 bits without sign
    bits = max(1, int(u.max()).bit_length()) if m.size else 1
    words = -(-len(ids) // 64)
    planes = np.zeros((m.shape[1], bits, words * 8), np.uint8)
    for d in range(m.shape[1]):
        for b in range(bits):
            packed = np.packbits(((u[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
            planes[d, b, : len(packed)] = packed
    return pd.DataFrame({"block": [key[0]], "low": [low], "bits": [bits], "ids": [ids.tobytes()], "planes": [planes.tobytes()]})


def _query_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    ids, m = _matrix(pdf)
    return pd.DataFrame({"grp": [key[0]], "qids": [ids.tobytes()], "qvec": [m.tobytes()]})


def _cut(df: DataFrame, rows: int, name: str, seed: int) -> tuple[DataFrame, int]:
    n = max(1, -(-df.count() // rows))
    # The row's place is hashed too: many rows of one id, or copies of one vector, spread over all blocks.
    return df.withColumn(name, F.pmod(F.xxhash64("id", F.monotonically_increasing_id(), F.lit(seed)), F.lit(n)).cast("int")), n


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The index of quantised vectors, written to the shared folder: one row per block."""
    cut, n = _cut(vectors, block_rows, "block", 1)
    index = cut.groupBy("block").applyInPandas(_index_block, "block int, low long, bits int, ids binary, planes binary")
    return materialise(index, "bit-slices"), n


def _scores(planes: np.ndarray, inverted: np.ndarray, vector: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Score bitmaps (least significant first) and the constant to add to them."""
    bits = planes.shape[1]
    waiting: list[list[np.ndarray]] = []
    constant = 0

    def add(weight: int, bitmap: np.ndarray) -> None:
        while True:
            while len(waiting) <= weight:
                waiting.append([])
            column = waiting[weight]
            column.append(bitmap)
            if len(column) < 3:
                return
            a, b, c = column
            half = a ^ b
            column[:] = [half ^ c]
            bitmap = (a & b) | (c & half)
            weight += 1

    for d, value in enumerate(vector.tolist()):
        # A negative factor adds the complement: -m * u = m * (2^bits - 1 - u) - m * (2^bits - 1).
        source = planes if value >= 0 else inverted
        if value < 0:
            constant += value * ((1 << bits) - 1)
        factor, shift = abs(value), 0
        while factor:
            if factor & 1:
                for b in range(bits):
                    add(shift + b, source[d, b])
            factor >>= 1
            shift += 1
    weight = 0
    while weight < len(waiting):
        if len(waiting[weight]) == 2:
            a, b = waiting[weight]
            waiting[weight] = [a ^ b]
            add(weight + 1, a & b)
        weight += 1
    zero = np.zeros(planes.shape[2], np.uint64)
    return [c[0] if c else zero for c in waiting], constant


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _best(slices: list[np.ndarray], there: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest rows; equal rows by place."""
    sure, tied = np.zeros_like(there), there
    for s in reversed(slices):
        more = sure | (tied & s)
        n = _count(more)
        if n > k:
            tied = tied & s
        else:
            sure, tied = more, tied & ~s
            if n == k:
                return _places(sure)
    got = _places(sure)
    return np.concatenate([got, _places(tied)[: k - len(got)]])


def _exact(slices: list[np.ndarray], places: np.ndarray, constant: int) -> tuple[list[int] | np.ndarray, list[bytes | None]]:
    """Scores at these places within 64 bits and, for those that had to be cut to that range, all their digits in order."""
    digits = [(s[places // 64] >> (places % 64).astype(np.uint64)) & np.uint64(1) for s in slices]
    if len(slices) < 62 and abs(constant) < 1 << 62:
        return constant + sum((d.astype(np.int64) << w for w, d in enumerate(digits)), np.zeros(len(places), np.int64)), [None] * len(places)
    full = [constant + sum(int(d[i]) << w for w, d in enumerate(digits)) for i in range(len(places))]
    wide = [None if LEAST <= x <= MOST else (x + (1 << 8 * WIDE - 1)).to_bytes(WIDE, "big") for x in full]
    return [min(max(x, LEAST), MOST) for x in full], wide


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for cell in pdf.itertuples(index=False):
            ids, qids = np.frombuffer(cell.ids, np.int64), np.frombuffer(cell.qids, np.int64)
            words = -(-len(ids) // 64)
            planes = np.frombuffer(cell.planes, np.uint64).reshape(-1, cell.bits, words)
            queries = np.frombuffer(cell.qvec, np.int64).reshape(len(qids), -1)
            inverted = ~planes
            full = np.zeros(words * 64, np.uint8)
            full[: len(ids)] = 1
            there = np.packbits(full, bitorder="little").view(np.uint64)
            out = []
            for q, vector in zip(qids, queries):
                vector = vector[: planes.shape[0]]
                slices, constant = _scores(planes, inverted, vector)
                mine, at, end = there, np.searchsorted(ids, q, "left"), np.searchsorted(ids, q, "right")
                if at < end:
                    others = full.copy()
                    others[at:end] = 0
                    mine = np.packbits(others, bitorder="little").view(np.uint64)
                places = _best(slices, mine, k)
                score, wide = _exact(slices, places, constant + cell.low * sum(vector.tolist()))
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[places], "score": score, "wide": wide}))
            if out:
                yield pd.concat(out)


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 20, scale: int = 64, every_row: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query row with all other rows."""

    def rows(part: DataFrame) -> DataFrame:
        whole = quantise(part, key, vector, scale)
        return whole if every_row else whole.groupBy("id").agg(F.min("v").alias("v"))

    vectors = rows(df)
    index, blocks = build_index(vectors)
    queries = rows(df.where(is_query))
    cut, groups = _cut(queries, QUERY_ROWS, "grp", 2)
    packed = cut.groupBy("grp").applyInPandas(_query_group, "grp int, qids binary, qvec binary")
    wide = packed.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "*")
    grid = index.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "*").join(wide, ["block", "grp"])
    part = grid.mapInPandas(lambda it: _search(it, k), "query_id long, vec_id long, score long, wide binary")
    beyond = F.when(F.col("wide").isNull(), 0).otherwise(F.signum("score").cast("int"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), beyond.desc(), F.desc("wide"), "vec_id")
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
