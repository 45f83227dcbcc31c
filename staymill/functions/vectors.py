"""Vector columns inside tasks, by their filled slots: a wide one-hot row costs what it holds, not its width."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unwrapped(df: DataFrame, column: str) -> Column:
    """The column as Arrow can carry it: the parts of a vector, or an array of doubles."""
    whole = df.schema[column].dataType.typeName() == "array"
    return F.col(column).cast("array<double>") if whole else F.unwrap_udt(column)


def width_and_filled(column: str) -> tuple[Column, Column]:
    """Width of a vector, and the values that it writes down: all of a dense one, the filled slots of a sparse one."""
    parts = F.unwrap_udt(column)
    return F.coalesce(parts["size"], F.size(parts["values"])), parts["values"]


@dataclass
class Rows:
    """Filled slots of some rows, one row after the other."""

    first: np.ndarray  # of each row, and one past the last
    slot: np.ndarray
    value: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Per row the product with the weights."""
        return np.bincount(self.row, self.value * weights[self.slot], minlength=len(self))

    def block(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(matrix, slots) of the picked rows: one column per slot that any of them fills."""
        counts = self.first[pick + 1] - self.first[pick]
        at = np.repeat(self.first[pick] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        seen = np.zeros(self.width, bool)
        seen[self.slot[at]] = True
        slots = np.flatnonzero(seen)
        out = np.zeros((len(pick), len(slots)), self.value.dtype)
        out[np.repeat(np.arange(len(pick)), counts), (np.cumsum(seen) - 1)[self.slot[at]]] = self.value[at]
        return out, slots

    def filled(self) -> Rows:
        """Without the slots that are written down as 0."""
        mine = self.value != 0
        return Rows(np.append(0, np.cumsum(mine))[self.first], self.slot[mine], self.value[mine], self.width)

    def cut(self, a: int, b: int) -> Rows:
        """The rows from a to b."""
        part = slice(self.first[a], self.first[min(b, len(self))])
        return Rows(self.first[a : b + 1] - self.first[a], self.slot[part], self.value[part], self.width)

    def back(self, factors: np.ndarray) -> np.ndarray:
        """Per slot the sum of its values times the factor of their row."""
        return np.bincount(self.slot, self.value * factors[self.row], minlength=self.width)


def rows_of(column: pa.Array) -> Rows:
    """Rows of an unwrapped column; a null row has no filled slot."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    vector = pa.types.is_struct(column.type)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    values = column.field("values") if vector else column
    counts = np.where(there, pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False), 0)
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    value = np.asarray(values.filter(column.is_valid()).flatten(), float)
    slot = np.arange(len(value)) - np.repeat(first[:-1], counts)
    width = int(counts.max(initial=0))
    if vector:
        sparse = there & (pc.fill_null(column.field("type"), 1).to_numpy(zero_copy_only=False) == 0)
        slot[np.repeat(sparse, counts)] = column.field("indices").filter(pa.array(sparse)).flatten()
        width = max(width, pc.max(column.field("size").filter(pa.array(sparse))).as_py() or 0)
    return Rows(first, slot, value, width)


def rows_in(matrix: np.ndarray) -> Rows:
    """Rows of a dense matrix."""
    n, width = matrix.shape
    return Rows(np.arange(n + 1) * width, np.tile(np.arange(width), n), matrix.ravel(), width)


def columns_of(x: Rows, row: np.ndarray, slots: np.ndarray, width: int) -> np.ndarray:
    """The named slots as columns."""
    place = np.full(max(width, x.width) + 1, -1)
    place[slots] = np.arange(len(slots))
    mine = place[x.slot] >= 0
    out = np.zeros((len(x), len(slots)))
    out[row[mine], place[x.slot[mine]]] = x.value[mine]
    return out


def slot_kinds(x: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Per slot: the furthest filled slot before it in a row that fills both (-1: none), and whether it holds only 0 and 1."""
    left, plain = np.full(x.width, -1), np.ones(x.width, bool)
    plain[x.slot[(x.value != 0) & (x.value != 1)]] = False
    x = x.filled()
    row = x.row
    near = row[1:] == row[:-1]
    np.maximum.at(left, x.slot[1:][near], x.slot[:-1][near])
    return left, plain


def bundles_of(left: np.ndarray, plain: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Slots [from, to) of each bundle: one slot, or a run of at most `most` 0/1 slots of which a row fills at most one."""
    out: list[tuple[int, int]] = []
    first, kind = 0, False
    for i, (l, p) in enumerate(zip(left.tolist(), plain.tolist())):
        if out and p and kind and l < first and i - first < most:
            out[-1] = (first, i + 1)
        else:
            out.append((i, i + 1))
            first, kind = i, p
    return out


@dataclass
class Packed:
    """Rows as one column per bundle of slots, whatever their width: the value of a slot, or the number of the filled 0/1 slot."""

    columns: np.ndarray  # (bundles + 1, rows); the last column is 0 and stands for slots beyond the width
    column: np.ndarray  # of each slot
    plain: np.ndarray  # whether the column names a slot

    def tests(self, slot: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(column, a, b): `x[slot] <= cut` is false where the column is above a and not above b."""
        inside = np.where(slot < len(self.column) - 1, slot, len(self.column) - 1)
        named = self.plain[inside]
        a = np.where(named, np.where(cut < 1, slot + 0.5, np.inf), cut)
        b = np.where(named, slot + 1.5, np.inf)
        return self.column[inside], np.where(named & (cut < 0), -np.inf, a), np.where(named & (cut < 0), np.inf, b)


def packed(x: Rows) -> Packed:
    x = x.filled()
    left, plain = slot_kinds(x)
    seen = np.unique(x.slot)
    groups = bundles_of(np.searchsorted(seen, left[seen], side="right") - 1, plain[seen], len(seen))
    size = [b - a for a, b in groups]
    column, named = np.full(x.width + 1, len(groups)), np.zeros(x.width + 1, bool)
    column[seen] = np.repeat(np.arange(len(groups)), size)
    named[seen] = plain[seen]
    out = np.zeros((len(groups) + 1, len(x)))
    out[column[x.slot], x.row] = np.where(named[x.slot], x.slot + 1.0, x.value)
    return Packed(out, column, named)


def slot_sums(df: DataFrame, column: str, part: Callable[[Rows, pa.RecordBatch], dict[str, np.ndarray]], names: list[str], *others: Column) -> dict[str, np.ndarray]:
    """Arrays over the slots of a vector column, summed over all rows: `part` gives those of a batch, with `others` beside it.

    Only sums per slot leave the tasks; the driver holds a few numbers per slot, never a square of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), 0))
        for b in batches:
            if not b.num_rows:
                continue
            got = part(rows_of(b.column("x")), b)
            one = np.stack([got[n] for n in names])
            if one.shape[1] > total.shape[1]:
                one[:, : total.shape[1]] += total
                total = one
            else:
                total[:, : one.shape[1]] += one
        yield pa.RecordBatch.from_pydict({"slot": np.arange(total.shape[1]), **dict(zip(names, total))})

    frame = df.select(unwrapped(df, column).alias("x"), *others)
    sums = frame.mapInArrow(partial, "slot long, " + ", ".join(f"{n} double" for n in names)).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names])
    got = sums.orderBy("slot").toPandas()
    return {n: got[n].to_numpy() for n in names}
