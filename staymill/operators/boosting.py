"""Second-order gradient boosting for two classes, all rounds of a fit in one barrier job.

Rows are binned once, from their filled slots, and written as small codes: numeric slots by quantiles, runs of 0/1 slots of
which a row fills at most one (a one-hot group) as one code that names the filled slot. Every task of the barrier job holds its
share of the rows. The upper levels of a tree are grown by all tasks together: each sums gradients and hessians per node and bin,
the sums meet, and every task finds the same splits. Once the nodes can be shared out evenly, the rows of a node go to one
task, which grows all that is below it; then the parts of the tree meet and every task learns the leaves of its rows.
The smaller child of a split is counted, its sibling is the parent less that. Wide one-hot groups are counted by their filled
slots below the upper levels.

Gradients are whole multiples of 2^-20, so their sums are exact in any order and the trees do not depend on how many tasks
there are. Rows are drawn per tree by a hash of their key. A lost task restarts the stage, as barrier stages do.

Scale: a row takes two bytes per bundle at most, however wide its vector; tasks hold about 2 MB of them, as many tasks as that
takes and the cluster has slots for. Per upper level a task sends `bins x nodes` pairs of sums, whatever the number of rows, and
per tree it sends and gets its rows once."""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.session import materialise
from staymill.functions.vectors import Packed, Rows, bundles_of, columns_of, packed, rows_in, rows_of, slot_kinds, unwrapped
from staymill.plans.barrier import Alone, Gather, gatherer, is_first, meeting_place, tasks_for, total, uniform

UNIT = float(1 << 20)  # gradients are counted in 1 / UNIT
KEPT_SUMS = 4_000_000  # sums of a level that are kept for its children
BLOCK_SUMS = 2_000_000  # sums that are searched for splits at once
TASK_BYTES = 2 << 20  # codes that a task holds, about
WIDE = 256  # slots of a one-hot group from which it is counted by its filled slots
SHARED = 4  # nodes per task before they are shared out
UNEVEN = 1.25  # most work of a task over the mean
UPPER = 8  # levels that are grown together at most
JUDGED = 10_000  # rows that go down the trees at once


# --- Bins ---------------------------------------------------------------------------


@dataclass
class Bins:
    """How a vector becomes bytes: bundles of slots, and the quantile cuts of numeric ones."""

    bundles: list[tuple[int, int]]  # slots [from, to) of each bundle
    cuts: list[list[float] | None]  # None: slots of 0 and 1, of which at most one is filled
    first: np.ndarray = field(init=False)  # first bin of each bundle
    bins: int = field(init=False)

    def __post_init__(self) -> None:
        sizes = [b - a + 1 if c is None else len(c) + 1 for (a, b), c in zip(self.bundles, self.cuts)]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.bins = int(self.first[-1])

    @property
    def dtype(self) -> type:
        return np.uint8 if max(b - a for a, b in self.bundles) < 256 else np.uint16

    def encode(self, x: Rows | np.ndarray) -> np.ndarray:
        x = (x if isinstance(x, Rows) else rows_in(x)).filled()
        width = max(x.width, self.bundles[-1][1])
        row, plain = x.row, np.array([c is None for c in self.cuts], bool)
        starts, sizes = np.array([a for a, _ in self.bundles]), [b - a for a, b in self.bundles]
        out = np.zeros((len(x), len(self.bundles)), self.dtype)
        of = np.full(width, -1)
        of[np.concatenate([np.arange(a, b) for a, b in self.bundles])] = np.repeat(np.arange(len(sizes)), sizes)
        here = of[x.slot]
        mine = (here >= 0) & plain[here]
        out[row[mine], here[mine]] = x.slot[mine] - starts[here[mine]] + 1
        numeric = np.flatnonzero(~plain)
        dense = columns_of(x, row, starts[numeric], width)
        for j, k in enumerate(numeric):
            out[:, k] = np.searchsorted(self.cuts[k], dense[:, j])
        return out

    def candidates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bin, bundle, slot, threshold) of every possible split: `x[slot] <= threshold` goes left."""
        rows = []
        for k, ((a, b), cuts) in enumerate(zip(self.bundles, self.cuts)):
            for i, cut in enumerate([0.5] * (b - a) if cuts is None else cuts):
                rows.append((self.first[k] + i + (cuts is None), k, a + i if cuts is None else a, cut))
        at, bundle, slot, cut = zip(*rows) if rows else ((), (), (), ())
        return np.array(at, np.int64), np.array(bundle, np.int64), np.array(slot, np.int64), np.array(cut, float)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slot: the furthest filled slot before it in a row that fills both, and whether it holds only 0 and 1."""
    left, plain = np.zeros(0, np.int64), np.zeros(0, bool)
    for batch in batches:
        if batch.num_rows:
            l, p = slot_kinds(rows_of(batch.column("x")))
            more = len(l) - len(left)
            left, plain = np.pad(left, (0, max(more, 0)), constant_values=-1), np.pad(plain, (0, max(more, 0)), constant_values=True)
            left[: len(l)], plain[: len(l)] = np.maximum(left[: len(l)], l), plain[: len(l)] & p
    if len(left):
        yield pa.RecordBatch.from_pydict({"slot": np.arange(len(left)), "left": left, "plain": plain})


def bundle_slots(frame: DataFrame) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(bundles of the slots of the column `x`, whether a slot holds only 0 and 1), in one pass."""
    slots = frame.select("x").mapInArrow(_slots, "slot long, left long, plain boolean")
    rows = slots.groupBy("slot").agg(F.max("left").alias("left"), F.bool_and("plain").alias("plain")).orderBy("slot").toPandas()  # one row per slot
    if not len(rows):
        raise ValueError("no rows to fit on")
    plain = rows["plain"].to_numpy(bool)
    return bundles_of(rows["left"].to_numpy(), plain, 65_535), plain


def fit_bins(frame: DataFrame, bins: int) -> Bins:
    """Bins of the column `x`, an array or an unwrapped vector: one pass for the bundles, one sketch for the cuts of numeric slots."""
    bundles, plain = bundle_slots(frame)
    numeric = np.array([a for a, _ in bundles if not plain[a]], np.int64)
    probs = [k / bins for k in range(1, bins)]
    found: dict[int, list[float]] = {}
    if len(numeric):

        def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = rows_of(b.column("x"))
                dense = columns_of(x, x.row, numeric, len(plain))
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(dense[:, j])) for j in range(len(numeric))], names=[f"v{a}" for a in numeric])

        values = frame.select("x").mapInArrow(columns, ", ".join(f"v{a} double" for a in numeric))
        got = values.agg(*[F.percentile_approx(f"v{a}", probs, 10_000).alias(f"q{a}") for a in numeric]).first()
        found = {int(a): sorted(set(got[f"q{a}"] or [])) for a in numeric}
    return Bins(bundles, [None if plain[a] else found[a] for a, _ in bundles])


# --- Growing ------------------------------------------------------------------------


@dataclass
class Settings:
    trees: int
    max_depth: int
    rate: float
    subsample: float
    colsample: float
    ridge: float = 1.0
    min_hessian: float = 1.0
    patience: int = 0  # trees without a better validation loss before growing stops; 0: never
    tolerance: float = 0.0
    seed: int = S.SEED


class _Dense:
    """Some of the bundles, their bins side by side, and the candidates on them."""

    def __init__(self, bins: Bins, bundles: np.ndarray, at: np.ndarray, bundle: np.ndarray, numeric: np.ndarray):
        sizes = np.diff(bins.first)[bundles]
        self.bundles, self.first = bundles, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        moved = np.zeros(len(bins.bundles), np.int64)
        moved[bundles] = self.first[:-1] - bins.first[bundles]
        self.at, self.start = at + moved[bundle], bins.first[bundle] + moved[bundle]
        self.mine, self.numeric = np.isin(bundle, bundles), numeric[bundle]

    @property
    def bins(self) -> int:
        return int(self.first[-1])

    def open(self, open_: np.ndarray) -> tuple[np.ndarray, int]:
        """(candidates in the order in which they win a tie, how many of them are numeric): sums up to a bin, then those outside one."""
        here = open_[self.mine[open_]]
        return np.concatenate([here[self.numeric[here]], here[~self.numeric[here]]]), int(self.numeric[here].sum())


@dataclass
class _State:
    """A level of a tree, or of some parts of one: the rows that are here, and its nodes."""

    columns: np.ndarray  # one run of codes per bundle
    g: np.ndarray
    h: np.ndarray
    node: np.ndarray  # of every row, numbered from 0 along the levels
    rows: np.ndarray  # the drawn ones
    totals: np.ndarray  # (2, nodes)
    top: np.ndarray  # of every node, the node above it that was shared out
    depth: int
    gather: Gather  # of sums
    meet: Gather | None  # of the tasks that grow other parts


class _Grower:
    """One task's rows, and the growing of trees that all tasks do alike."""

    def __init__(self, codes: np.ndarray, bins: Bins, settings: Settings, gather: Gather):
        self.bins, self.s, self.gather = bins, settings, gather
        self.at, self.bundle, self.slot, self.cut = bins.candidates()
        self.start = bins.first[self.bundle]
        self.numeric = np.array([c is not None for c in bins.cuts], bool)
        self.columns = np.ascontiguousarray(codes.T)
        wide = ~self.numeric & np.array([b - a >= WIDE for a, b in bins.bundles], bool)
        self.full, self.narrow = (_Dense(bins, np.flatnonzero(m), self.at, self.bundle, self.numeric) for m in (np.ones(len(wide), bool), ~wide))
        self.wide = np.flatnonzero(wide)
        self.tasks = len(gather(np.zeros(1)))

    def sums(self, st: _State, dense: _Dense, rows: np.ndarray, at: np.ndarray, nodes: int) -> np.ndarray:
        """(2, nodes, bins): gradients and hessians of the rows by node and bin, over the tasks that hold rows of these nodes."""
        out = np.empty((2, nodes, dense.bins))
        gh = st.g[rows], st.h[rows]
        for column, a, b in zip(st.columns[dense.bundles] if len(dense.bundles) < len(st.columns) else st.columns, dense.first[:-1], dense.first[1:]):
            key = at * (b - a)
            key += column[rows]
            for k, v in enumerate(gh):
                out[k, :, a:b] = np.bincount(key, v, minlength=nodes * (b - a)).reshape(nodes, b - a)
        return total(st.gather, out)

    def divisible(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return h >= 2 * self.s.min_hessian

    def ranks(self, st: _State, can: np.ndarray) -> tuple[np.ndarray | None, bool]:
        """(numbers of the divisible nodes, by which they draw features, or None; whether the tree is at its end)."""
        return None, not can.any()

    def barred(self, ranks: np.ndarray) -> np.ndarray:
        """(nodes, slots): which slots the nodes may not use."""
        raise NotImplementedError

    def _score(self, low: np.ndarray, whole: np.ndarray) -> np.ndarray:
        (gl, hl), (g, h) = low, whole
        gr, hr = g - gl, h - hl
        with np.errstate(divide="ignore", invalid="ignore"):  # empty sides, which are struck out next
            score = gl * gl / (hl + self.s.ridge) + gr * gr / (hr + self.s.ridge)
        score[(hl < self.s.min_hessian) | (hr < self.s.min_hessian)] = -1.0
        return score

    def best(self, dense: _Dense, order: np.ndarray, n: int, sums: np.ndarray, totals: np.ndarray, barred: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, candidate, sums of its left side) of the best split of each node among `order`, of which the first n are numeric."""
        nodes = sums.shape[1]
        score, choice, left = np.full(nodes, -2.0), np.zeros(nodes, np.int64), np.zeros((2, nodes))
        upto, outside, start = dense.at[order[:n]] + 1, dense.at[order[n:]], dense.start[order[:n]]
        step = max(1, BLOCK_SUMS // max(dense.bins, 1) // 8)
        for a in range(0, nodes if len(order) else 0, step):
            part, whole = sums[:, a : a + step], totals[:, a : a + step, None]
            low = np.empty((2, part.shape[1], len(order)))
            run = np.zeros((2, part.shape[1], part.shape[2] + 1))
            np.cumsum(part, axis=2, out=run[:, :, 1:])
            np.subtract(run.take(upto, axis=2), run.take(start, axis=2), out=low[:, :, :n])
            np.subtract(whole, part.take(outside, axis=2), out=low[:, :, n:])
            low /= UNIT
            every = self._score(low, whole / UNIT)
            if barred is not None:
                every[barred[a : a + step][:, self.slot[order]]] = -1.0
            top = every.argmax(axis=1)
            each = np.arange(len(top))
            score[a : a + step], choice[a : a + step], left[:, a : a + step] = every[each, top], order[top], low[:, each, top] * UNIT
        return score, choice, left

    def _filled(self, st: _State, rows: np.ndarray, at: np.ndarray, is_open: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Per wide bundle (node, candidate, gradients, hessians) of the slots that rows of a node fill."""
        out = []
        for k in self.wide:
            code = st.columns[k][rows].astype(np.int64)
            some = np.flatnonzero(code)
            bits = max(1, int(len(some)).bit_length())
            size = int(self.bins.first[k + 1] - self.bins.first[k])
            key = at[some] * size
            key += code[some]
            key <<= bits
            key |= np.arange(len(some))
            key.sort()
            by = rows[some[key & ((1 << bits) - 1)]]
            key >>= bits
            if not len(key):
                continue
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            node, code = np.divmod(key[first], size)
            candidate = code - 1 + int(np.searchsorted(self.bundle, k))
            g, h = (np.add.reduceat(v[by], first) for v in (st.g, st.h))
            mine = is_open[candidate]
            out.append((node[mine], candidate[mine], g[mine], h[mine]))
        return out

    def _better(self, found: tuple, pairs: list[tuple], a: int, b: int, totals: np.ndarray, barred: np.ndarray | None) -> None:
        """Splits on wide bundles of the nodes from a to b, where they beat those found."""
        score, choice, left = found
        for node, candidate, g, h in pairs:
            part = slice(*np.searchsorted(node, (a, b)))
            at, c = node[part] - a, candidate[part]
            if not len(at):
                continue
            whole = totals[:, a:b][:, at]
            low = whole - np.stack([g[part], h[part]])
            every = self._score(low / UNIT, whole / UNIT)
            if barred is not None:
                every[barred[at, self.slot[c]]] = -1.0
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            top = np.maximum.reduceat(every, first)
            size = np.diff(np.append(first, len(at)))
            pick = np.minimum.reduceat(np.where(every == np.repeat(top, size), np.arange(len(at)), len(at)), first)
            n = at[pick]
            tie = (top == score[n]) & ~self.numeric[self.bundle[choice[n]]] & (c[pick] < choice[n])
            won = (top > score[n]) | tie
            n, pick = n[won], pick[won]
            score[n], choice[n], left[:, n] = top[won], c[pick], low[:, pick]

    def _levels(self, st: _State, dense: _Dense, open_: np.ndarray, together: bool) -> tuple[list[dict], int]:
        """Levels from the given one on, and -1; with `together` those before the nodes can be shared out, and the number of the first of these."""
        order, numeric = dense.open(open_)
        is_open = np.zeros(len(self.at), bool)
        is_open[open_] = True
        levels: list[dict[str, np.ndarray]] = []
        off, n = 0, len(st.node)
        live, at, drawn = np.arange(n), st.node.copy(), np.zeros(n, bool)  # rows of the level, their nodes in it, and whether they are drawn
        drawn[st.rows] = True
        codes = st.columns.ravel()
        kept, counted = None, np.zeros(0, bool)  # sums of the parents; which child of each pair is counted
        while True:
            size = len(st.top)
            gs, hs = st.totals / UNIT
            st.node[live] = off + at
            if together and self._shared(st, dense) is not None:
                return levels, off
            now = {
                "feature": np.full(size, -1), "threshold": np.zeros(size), "left": np.full(size, -1), "right": np.full(size, -1),
                "value": -gs / (hs + self.s.ridge) * self.s.rate if size else np.zeros(0), "cover": hs, "top": st.top,
            }
            levels.append(now)
            can = self.divisible(gs, hs)
            if st.depth >= self.s.max_depth or not len(open_):
                return levels, -1
            ranks, over = self.ranks(st, can)
            if over:
                return levels, -1
            split, best = np.zeros(0, bool), None
            if can.any():
                rows, here = live[drawn], at[drawn]
                sums = None
                if kept is not None:
                    small = counted[here]
                    ours = self.sums(st, dense, rows[small], here[small] // 2, size // 2)  # siblings stand side by side, one of each pair is counted
                    pairs, first = np.arange(size // 2), counted[0::2]
                    sums = np.empty((2, size, dense.bins))
                    sums[:, 2 * pairs + ~first] = ours
                    sums[:, 2 * pairs + first] = np.subtract(kept, ours, out=kept)
                    if not can.all():
                        sums = sums[:, can]
                if not can.all():
                    mine = can[here]
                    rows, here = rows[mine], (np.cumsum(can) - 1)[here[mine]]
                best, sums = self._search(st, dense, order, numeric, is_open, rows, here, st.totals[:, can], sums, ranks)
                g, h = st.totals[:, can] / UNIT
                split = best[0] - g * g / (h + self.s.ridge) > 1e-9
            if not split.any() and (st.meet is None or ranks is None):
                return levels, -1
            parents, picks = np.flatnonzero(can)[split], best[1][split] if best else np.zeros(0, np.int64)
            now["feature"][parents], now["threshold"][parents] = self.slot[picks], self.cut[picks]
            now["left"][parents] = off + size + 2 * np.arange(len(parents))
            now["right"][parents] = now["left"][parents] + 1
            inner = now["feature"] >= 0
            if not inner.all():
                go = inner[at]
                live, at, drawn = live[go], at[go], drawn[go]
            bundle, last = np.zeros(size, np.int64), np.zeros(size, np.int64)
            bundle[parents] = self.bundle[picks]
            last[parents] = self.at[picks] - self.start[picks]
            is_numeric = self.numeric[bundle]
            code = codes[(bundle * n)[at] + live]  # codes above `last` go right if they are numbers, the code `last` if it names a slot
            right = (code > np.where(is_numeric, last, last - 1)[at]) & (code <= np.where(is_numeric, 65_536, last)[at])
            at = (now["left"] - off - size)[at] + right
            off, size = off + size, 2 * len(parents)
            whole, totals = st.totals[:, parents], np.empty((2, size))
            kept = None
            if len(parents):
                totals[:, 0::2] = best[2][:, split]
                totals[:, 1::2] = whole - totals[:, 0::2]
                kept = sums[:, split] if sums is not None and 4 * len(parents) * dense.bins <= KEPT_SUMS else None
            counted = np.zeros(size, bool)
            right_smaller = totals[1, 1::2] < totals[1, 0::2]
            counted[0::2], counted[1::2] = ~right_smaller, right_smaller
            st.totals, st.top, st.depth = totals, np.repeat(st.top[parents], 2), st.depth + 1

    def _search(self, st: _State, dense: _Dense, order: np.ndarray, n: int, is_open: np.ndarray, rows: np.ndarray, at: np.ndarray, totals: np.ndarray, sums: np.ndarray | None, ranks: np.ndarray | None):
        """The best splits of a level's divisible nodes, in blocks of nodes, and the sums of the level if they are few."""
        nodes = totals.shape[1]
        step = max(1, KEPT_SUMS // max(dense.bins, 1) // 2)
        if sums is None and nodes <= step:
            sums = self.sums(st, dense, rows, at, nodes)
        pairs = self._filled(st, rows, at, is_open) if dense is self.narrow else []
        if ranks is not None:
            step = min(step, max(1, BLOCK_SUMS // self.bins.bundles[-1][1]))
        found = []
        for a in range(0, nodes, step):
            b = min(nodes, a + step)
            if sums is not None:
                part = sums[:, a:b]
            else:
                here = (at >= a) & (at < b)
                part = self.sums(st, dense, rows[here], at[here] - a, b - a)
            barred = None if ranks is None else self.barred(ranks[a:b])
            found.append(self.best(dense, order, n, part, totals[:, a:b], barred))
            self._better(found[-1], pairs, a, b, totals, barred)
        return [np.concatenate(x, axis=-1) for x in zip(*found)], sums

    def forced(self, st: _State, dense: _Dense) -> bool:
        """Whether the nodes are shared out however uneven they are."""
        return st.depth >= UPPER or 2 * len(st.top) * dense.bins > KEPT_SUMS

    def _shared(self, st: _State, dense: _Dense) -> np.ndarray | None:
        """The task that gets each node of the level, or None if the level should be grown together."""
        work, tasks = st.totals[1], self.tasks
        forced = self.forced(st, dense)
        if st.depth >= self.s.max_depth or not forced and len(work) < SHARED * tasks:
            return None
        load, owner = np.zeros(tasks), np.zeros(len(work), np.int64)
        for i in np.argsort(-work, kind="stable"):
            owner[i] = load.argmin()
            load[owner[i]] += work[i]
        return owner if forced or load.max() <= UNEVEN * load.mean() else None

    def grow(self, g: np.ndarray, h: np.ndarray, drawn: np.ndarray, open_: np.ndarray) -> tuple[dict, np.ndarray]:
        """One tree as flat arrays, and the leaf of every row. g and h are 0 outside the drawn rows."""
        alone = self.tasks == 1
        totals = total(self.gather, np.array([[g.sum()], [h.sum()]]))
        st = _State(self.columns, g, h, np.zeros(len(g), np.int64), np.flatnonzero(drawn), totals, np.zeros(1, np.int64), 0, self.gather, None)
        self.begin()
        levels, off = self._levels(st, self.narrow if alone else self.full, open_, not alone)
        if off >= 0:
            levels = self._share(st, levels, off, drawn, open_)
        return {k: np.concatenate([x[k] for x in levels]) for k in levels[0] if k != "top"}, st.node

    def begin(self) -> None:
        """Before a tree."""

    def _share(self, st: _State, levels: list[dict], off: int, drawn: np.ndarray, open_: np.ndarray) -> list[dict]:
        """Every task grows its nodes of the level that begins at `off`, with the rows of all tasks; the parts come together in the order of nodes."""
        owner, me = self._shared(st, self.full), self.gather.me
        live = np.flatnonzero(st.node >= off)
        to = owner[st.node[live] - off]
        mine = [live[to == k] for k in range(self.tasks)]
        got = self.gather.deal([pickle.dumps((st.columns[:, r], st.g[r], st.h[r], st.node[r] - off, drawn[r]), protocol=5) for r in mine])
        got = [pickle.loads(b) for b in got]
        edges = np.cumsum([0, *[len(x[1]) for x in got]])
        columns, g, h, node, there = (np.concatenate(x, axis=-1) for x in zip(*got))
        del got
        tops = np.flatnonzero(owner == me)
        sub = _State(columns, g, h, np.searchsorted(tops, node), np.flatnonzero(there), st.totals[:, tops], tops, st.depth, Alone(), self.gather)
        self.tops = len(owner)
        parts, _ = self._levels(sub, self.narrow, open_, False)
        got = [pickle.loads(b) for b in self.gather.deal([pickle.dumps((parts, sub.node[a:b]), protocol=5) for a, b in zip(edges, edges[1:])])]
        name = [np.zeros(sum(len(x["top"]) for x in p), np.int64) for p, _ in got]  # of the nodes of each task, in the whole tree
        seen, at = [0] * self.tasks, off
        for d in range(max(len(p) for p, _ in got)):
            here = [(k, p[d]) for k, (p, _) in enumerate(got) if d < len(p)]
            whole = {c: np.concatenate([x[c] for _, x in here]) for c in here[0][1]}
            order = np.argsort(whole["top"], kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = at + np.arange(len(order))
            begun = 0
            for k, x in here:
                n = len(x["top"])
                name[k][seen[k] : seen[k] + n] = place[begun : begun + n]
                seen[k], begun = seen[k] + n, begun + n
            whole = {c: v[order] for c, v in whole.items()}
            inner = whole["feature"] >= 0
            whole["left"][inner] = at + len(order) + 2 * np.arange(inner.sum())
            whole["right"][inner] = whole["left"][inner] + 1
            at += len(order)
            levels.append(whole)
        for k, (_, leaf) in enumerate(got):
            st.node[mine[k]] = name[k][leaf]
        return levels


def _loss(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(sum, weight) of the logistic loss, in whole units."""
    each = np.logaddexp(0, margin) - y * margin
    return np.array([np.rint(each * w * UNIT).sum(), np.rint(w * UNIT).sum()])


def train(codes: np.ndarray, y: np.ndarray, w: np.ndarray, held: np.ndarray, keys: np.ndarray, bins: Bins, settings: Settings, gather: Gather) -> tuple[float, list[dict]]:
    """(base margin, trees), the same in every task. Rows that are `held` only judge when to stop."""
    grower = _Grower(codes, bins, settings, gather)
    learn = ~held
    pos, all_ = total(gather, np.array([np.rint(w * y * UNIT)[learn].sum(), np.rint(w * UNIT)[learn].sum()]))
    share = min(max(pos / max(all_, 1.0), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    width = max((b for _, b in bins.bundles), default=0)
    trees: list[dict] = []
    best, best_at = np.inf, 0
    for t in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        drawn = learn & (uniform(keys, settings.seed * 100_003 + 2 * t) < settings.subsample)
        g, h = np.rint(w * (p - y) * UNIT) * drawn, np.rint(w * p * (1 - p) * UNIT) * drawn
        rank = np.argsort(uniform(np.arange(width), settings.seed * 100_003 + 2 * t + 1))
        chosen = np.zeros(width, bool)
        chosen[rank[: max(1, int(settings.colsample * width))]] = True
        tree, node = grower.grow(g, h, drawn, np.flatnonzero(chosen[grower.slot]))
        margin += tree["value"][node]
        losses = total(gather, np.stack([_loss(margin[m], y[m], w[m]) for m in (learn, held)]))
        tree["loss"], tree["held_loss"] = (float(a / b) if b else None for a, b in losses)
        trees.append(tree)
        if settings.patience and tree["held_loss"] is not None:
            if tree["held_loss"] < best - settings.tolerance:
                best, best_at = tree["held_loss"], t
            elif t - best_at >= settings.patience:
                break
    return base, trees[: best_at + 1] if settings.patience and best < np.inf else trees


_BINNED = "codes binary, y double, w double, held boolean, k long"
_TREES = "tree int, base double, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, cover array<double>, loss double, held_loss double"


def _codes(column: pa.Array, width: int, dtype: type) -> np.ndarray:
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(dtype).itemsize
    return np.frombuffer(column.buffers()[2], dtype, count=int(at[-1] - at[0]) // size, offset=int(at[0])).reshape(-1, width)


def _job(batches: Iterator[pa.RecordBatch], bins: Bins, settings: Settings, trainer: Callable, folder: str | None) -> Iterator[pa.RecordBatch]:
    gather = gatherer(folder)
    width, dtype = len(bins.bundles), bins.dtype
    parts = [
        (_codes(b.column("codes"), width, dtype), *[np.asarray(b.column(c).to_numpy(zero_copy_only=False)) for c in ("y", "w", "held", "k")])
        for b in batches if b.num_rows
    ]
    blank = (np.zeros((0, width), dtype), np.zeros(0), np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64))
    rows = [np.concatenate(p) for p in zip(blank, *parts)]
    del parts
    base, trees = trainer(*rows, bins, settings, gather)
    if is_first():
        for t, tree in enumerate(trees):
            yield pa.RecordBatch.from_pylist([{"tree": t, "base": base, **{k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in tree.items()}}], _ARROW_TREES)


_ARROW_TREES = pa.schema([
    ("tree", pa.int32()), ("base", pa.float64()), ("feature", pa.list_(pa.int32())), ("threshold", pa.list_(pa.float64())), ("left", pa.list_(pa.int32())),
    ("right", pa.list_(pa.int32())), ("value", pa.list_(pa.float64())), ("cover", pa.list_(pa.float64())), ("loss", pa.float64()), ("held_loss", pa.float64()),
])


class Boosting(Estimator):
    """Estimator over a vector column and a 0/1 label; optional weight and validation columns."""

    def __init__(self, settings: Settings, features: str = "features", label: str = "label", weight: str | None = None, validation: str | None = None,
                 key: str = S.KEY, bins: int = 64, tasks: int | None = None):
        super().__init__()
        self.settings, self.features, self.label, self.weight, self.validation = settings, features, label, weight, validation
        self.key, self.bins, self.tasks = key, bins, tasks

    def getMaxIter(self) -> int:
        return self.settings.trees

    def getMaxDepth(self) -> int:
        return self.settings.max_depth

    def _fit(self, df: DataFrame) -> BoostingModel:
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        held = F.col(self.validation).cast("boolean") if self.validation else F.lit(False)
        key = F.xxhash64(self.key) if self.key in df.columns else F.monotonically_increasing_id()
        frame = df.select(unwrapped(df, self.features).alias("x"), F.col(self.label).cast("double").alias("y"), weight.alias("w"), held.alias("held"), key.alias("k"))
        bins = fit_bins(frame, self.bins)

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    codes = bins.encode(rows_of(b.column("x")))
                    whole = pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes[0].nbytes), len(codes), [None, pa.py_buffer(codes.tobytes())])
                    yield pa.RecordBatch.from_arrays([whole.cast(pa.binary()), *[b.column(c) for c in ("y", "w", "held", "k")]], names=["codes", "y", "w", "held", "k"])

        binned = materialise(frame.mapInArrow(encode, _BINNED), "binned")
        rows = binned.count()
        tasks = self.tasks or tasks_for(binned, rows * len(bins.bundles), TASK_BYTES)
        settings, trainer = self.settings, self.trainer()
        with meeting_place(df.sparkSession) as folder:
            grown = binned.repartition(tasks, "k").mapInArrow(lambda it: _job(it, bins, settings, trainer, folder), _TREES, barrier=True)
            return self.model.of(materialise(grown, "trees"), self.features)

    @property
    def model(self) -> type[BoostingModel]:
        return BoostingModel

    def trainer(self) -> Callable:
        return train


class BoostingModel(Model, MLWritable, MLReadable):
    """The trees as flat node arrays: children, tests `x[feature] <= threshold`, leaf values and covers."""

    def __init__(self, trees: list[dict] | None = None, base: float = 0.0, features: str = "features"):
        super().__init__()
        self.trees, self.base, self.features = trees or [], base, features

    @classmethod
    def of(cls, table: DataFrame, features: str) -> BoostingModel:
        rows = table.orderBy("tree").collect()  # the model: at most `trees` trees of `max_depth` levels
        trees = [{k: np.array(r[k]) for k in ("feature", "threshold", "left", "right", "value", "cover")} | {"loss": r["loss"], "held_loss": r["held_loss"]} for r in rows]
        return cls(trees, rows[0]["base"] if rows else 0.0, features)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def copy(self, extra=None) -> BoostingModel:
        return type(self)(self.trees, self.base, self.features)

    def margins(self, x: Rows | np.ndarray, every: bool = False) -> np.ndarray:
        """Log-odds of the rows; with `every`, after each tree as one column per tree."""
        x = x if isinstance(x, Rows) else rows_in(x)
        parts = [self._margins(packed(x.cut(a, a + JUDGED)), every) for a in range(0, len(x), JUDGED)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.trees)) if every else 0)

    def _margins(self, x: Packed, every: bool) -> np.ndarray:
        n = x.columns.shape[1]
        out = np.empty((n, len(self.trees))) if every else np.zeros(0)
        run = np.full(n, self.base)
        everyone = np.arange(n)
        flat = x.columns.ravel()
        for t, tree in enumerate(self.trees):
            column, a, b = x.tests(tree["feature"], tree["threshold"])
            column, left, right, inner = column * n, tree["left"], tree["right"], tree["left"] >= 0
            node, live = np.zeros(n, np.int64), everyone
            while len(live):
                at = node[live]
                go = inner[at]
                live, at = (live, at) if go.all() else (live[go], at[go])
                v = flat[column[at] + live]
                node[live] = np.where((v > a[at]) & (v <= b[at]) | (v != v), right[at], left[at])
            run = run + tree["value"][node]
            if every:
                out[:, t] = run
        return out if every else run

    def _transform(self, df: DataFrame) -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(self._plain())

        @F.arrow_udf("double")
        def margin(column: pa.Array) -> pa.Array:
            return pa.array(held.value.margins(rows_of(column)), mask=column.is_null().to_numpy(zero_copy_only=False))

        return df.withColumn("_margin", margin(unwrapped(df, self.features))).withColumns(self._judged(F.col("_margin"))).drop("_margin")

    def _judged(self, m: Column) -> dict[str, Column]:
        p = 1 / (1 + F.exp(-m))
        return {"rawPrediction": array_to_vector(F.array(-m, m)), "probability": array_to_vector(F.array(1 - p, p)), "prediction": (m > 0).cast("double")}

    def _plain(self) -> _Trees:
        return _Trees(self.trees, self.base)

    def evaluateEachIteration(self, df: DataFrame, label: str = "label") -> list[float]:
        """Mean logistic loss after every tree."""
        held = df.sparkSession.sparkContext.broadcast(self._plain())

        def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = 0.0, 0
            for b in batches:
                y = np.asarray(b.column("y"))
                x = rows_of(b.column("x"))
                for a in range(0, len(y), 2000):
                    m = held.value.margins(x.cut(a, a + 2000), every=True)
                    total = total + (np.logaddexp(0, m) - y[a : a + 2000, None] * m).sum(axis=0)
                    n += len(m)
            if n:
                yield pa.RecordBatch.from_pydict({"i": np.arange(len(total)), "total": total, "n": np.full(len(total), n)})

        frame = df.select(unwrapped(df, self.features).alias("x"), F.col(label).cast("double").alias("y"))
        rows = frame.mapInArrow(losses, "i long, total double, n long").groupBy("i").agg((F.sum("total") / F.sum("n")).alias("loss")).orderBy("i").collect()
        return [r["loss"] for r in rows]

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Trees:
    """What travels to the workers."""

    margins, _margins = BoostingModel.margins, BoostingModel._margins

    def __init__(self, trees: Sequence[dict], base: float):
        self.trees, self.base = list(trees), base


class _Writer(MLWriter):
    def __init__(self, model: BoostingModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"base": self.model.base, "features": self.model.features})
        rows = [{"tree": t, "base": self.model.base, **{k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in tree.items()}} for t, tree in enumerate(self.model.trees)]
        spark.createDataFrame(pd.DataFrame({"tree": [r["tree"] for r in rows], "data": [json.dumps(r) for r in rows]}), "tree int, data string").write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, made: type[BoostingModel]):
        super().__init__()
        self.made = made

    def load(self, path: str) -> BoostingModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/trees").select(F.from_json("data", _TREES).alias("t")).select("t.*")
        model = self.made.of(rows, meta["features"])
        model.base = meta["base"]
        model._resetUid(meta["uid"])
        return model
