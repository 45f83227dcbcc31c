"""A single classification tree over the filled slots of a vector; the result is a model of Spark's own class.

Spark's learner keeps an int per row and slot, so a wide one-hot vector costs its width. Here a row is the list of bins it fills:
one per numeric slot, one per filled 0/1 slot. Nodes of many rows are split level by level: tasks count by node and bin, the
counts meet in a shuffle, and the best split of each node is found where its counts are. A node of `LOCAL_ROWS` rows or fewer
is grown to its end in one task, all such nodes side by side after one shuffle of the rows.

Candidates, gains, least rows, ties and pruning are those of Spark's learner. Bounds of numeric bins come from all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import materialise, scratch_path
from staymill.functions.vectors import Rows, columns_of, rows_of, slot_sums, unwrapped

LOCAL_ROWS = 50_000  # rows of a node that is grown in one task
HELD_SUMS = 4_000_000  # counts by node and bin that a task holds
VALUES = 20_000  # different values of a slot up to which bounds follow Spark's rule; beyond that they are quantiles
EPSILON = 2.0**-52

_SPLITS = "node long, at long, gain double, n0 double, n1 double, n long, r0 double, r1 double, r long"
_GROWN = "node long, at long, gain double, n0 double, n1 double, n long"


@dataclass
class Layout:
    """Bins in the order of slots: `cuts` of a numeric slot give one bin more than cuts, a 0/1 slot (None) has one bin, filled."""

    slots: np.ndarray
    cuts: list[np.ndarray | None]
    width: int
    start: np.ndarray = field(init=False)  # first bin of each slot, and one past the last
    numeric: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.start = np.concatenate([[0], np.cumsum([1 if c is None else len(c) + 1 for c in self.cuts])]).astype(np.int64)
        self.numeric = np.flatnonzero([c is not None for c in self.cuts])
        size = [1 if c is None else len(c) for c in self.cuts]
        of = np.repeat(np.arange(len(self.cuts)), size)
        self.at = self.start[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) if len(of) else np.zeros(0, np.int64)  # bin of each candidate
        self.of, self.plain = of.astype(np.int64), np.array([self.cuts[i] is None for i in of], bool)

    def encode(self, x: Rows) -> tuple[np.ndarray, np.ndarray]:
        """(first, codes): filled bins, row by row; those of the numeric slots come first."""
        k, n = len(self.numeric), len(x)
        row = x.row
        dense = columns_of(x, row, self.slots[self.numeric], self.width)
        bin_of = np.full(max(self.width, x.width) + 1, -1)
        plain = np.setdiff1d(np.arange(len(self.slots)), self.numeric)
        bin_of[self.slots[plain]] = self.start[plain]
        mine = (bin_of[x.slot] >= 0) & (x.value != 0)
        counts = np.bincount(row[mine], minlength=n)
        first = np.concatenate([[0], np.cumsum(counts + k)]).astype(np.int64)
        out = np.empty(first[-1], np.int32)
        for j, i in enumerate(self.numeric):
            out[first[:-1] + j] = self.start[i] + np.searchsorted(self.cuts[i], dense[:, j])
        out[first[row[mine]] + k + np.arange(mine.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = bin_of[x.slot[mine]]
        return first, out

    def goes_left(self, first: np.ndarray, codes: np.ndarray, rows: np.ndarray, candidate: np.ndarray) -> np.ndarray:
        """Whether the rows go left at the given candidates."""
        place = np.full(len(self.slots), -1)
        place[self.numeric] = np.arange(len(self.numeric))
        of, at = self.of[candidate], self.at[candidate]
        left = np.ones(len(rows), bool)
        number = np.flatnonzero(~self.plain[candidate])
        left[number] = codes[first[rows[number]] + place[of[number]]] <= at[number]
        rest = np.flatnonzero(self.plain[candidate])
        counts = (first[1:] - first[:-1])[rows[rest]]
        where = np.repeat(first[rows[rest]] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        left[rest] = np.bincount(np.repeat(np.arange(len(rest)), counts), codes[where] == np.repeat(at[rest], counts), len(rest)) == 0
        return left


def spark_cuts(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Bounds of at most `bins` bins over sorted values: midway between neighbours, by strides of equal weight if they are too many."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= bins - 1:
        return middle
    stride = counts.sum() / bins
    out, target = [], stride
    run = np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(run[i - 1] - target) < abs(run[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def impurity(kind: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        shares = a / (a + b), b / (a + b)
        if kind == "gini":
            return 1.0 - shares[0] * shares[0] - shares[1] * shares[1]
        each = [np.where(p > 0, p * (np.log(p) / np.log(2)), 0.0) for p in shares]
        return 0.0 - each[0] - each[1]


@dataclass
class Rule:
    layout: Layout
    kind: str
    least: int

    def best(self, sums: np.ndarray, whole: np.ndarray) -> tuple[int, float, np.ndarray]:
        """(candidate, gain, sums of its left side) from (3, bins) counts of class 0, of class 1 and of rows; candidate -1: none."""
        y = self.layout
        if not len(y.at):
            return -1, 0.0, whole
        run = np.zeros((3, sums.shape[1] + 1))
        np.cumsum(sums, axis=1, out=run[:, 1:])
        left = np.where(y.plain, whole[:, None] - sums[:, y.at], run[:, y.at + 1] - run[:, y.start[y.of]])
        right = whole[:, None] - left
        wl, wr, w = left[0] + left[1], right[0] + right[1], whole[0] + whole[1]
        gain = impurity(self.kind, whole[0], whole[1]) - wl / w * impurity(self.kind, *left[:2]) - wr / w * impurity(self.kind, *right[:2])
        gain[(left[2] < self.least) | (right[2] < self.least) | ~np.isfinite(gain)] = -1.0
        i = int(gain.argmax())
        return (i, float(gain[i]), left[:, i]) if gain[i] > 0 else (-1, 0.0, whole)

    def pure(self, whole: np.ndarray) -> bool:
        return abs(float(impurity(self.kind, whole[0], whole[1]))) < EPSILON


def _parts(b: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, codes, y, w) of encoded rows."""
    column = b.column("codes")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    first = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return first, np.asarray(column.flatten()), np.asarray(b.column("y")), np.asarray(b.column("w"))


def _counts(node: np.ndarray, nodes: int, bins: int, first: np.ndarray, codes: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(3, nodes, bins): weight of class 0, of class 1, and rows; `node` is -1 for rows that do not count."""
    each = np.diff(first)
    key = np.repeat(node, each)
    mine = key >= 0
    key = key[mine] * bins + codes[mine]
    ones = np.repeat(w * y, each)[mine]
    return np.stack([np.bincount(key, v, nodes * bins).reshape(nodes, bins) for v in (np.repeat(w, each)[mine] - ones, ones, np.ones(len(key)))])


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together until they have so many rows: counting a few rows costs a whole table of counts."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(map(len, held)) > rows:
            yield pa.Table.from_batches(held)
            held = []
    if sum(map(len, held)):
        yield pa.Table.from_batches(held)


def route(layout: Layout, splits: dict[int, int], first: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The node of every row, numbered as in a heap from 1; `splits` gives the candidate of each split node."""
    node = np.ones(len(first) - 1, np.int64)
    names = np.array(sorted(splits), np.int64)
    picks = np.array([splits[i] for i in names], np.int64)
    live = np.arange(len(node))
    while len(live) and len(names):
        at = np.minimum(np.searchsorted(names, node[live]), len(names) - 1)
        inner = names[at] == node[live]
        live, at = live[inner], at[inner]
        node[live] = 2 * node[live] + ~layout.goes_left(first, codes, live, picks[at])
    return node


def grow_local(root: int, table: pa.Table, rule: Rule, depth: int) -> list[tuple]:
    """All nodes under `root`, whose rows are the table."""
    first, codes, y, w = _parts(table)
    each, bins = np.diff(first), int(rule.layout.start[-1])
    own = np.stack([w * (1 - y), w * y, np.ones(len(y))])
    out, todo = [], [(root, np.arange(len(y)))]
    while todo:
        node, rows = todo.pop()
        whole = own[:, rows].sum(axis=1)
        pick, gain = -1, 0.0
        if node.bit_length() - 1 < depth and not rule.pure(whole):
            where = np.repeat(first[rows] - np.cumsum(each[rows]) + each[rows], each[rows]) + np.arange(each[rows].sum())
            mine = np.concatenate([[0], np.cumsum(each[rows])])
            sums = _counts(np.zeros(len(rows), np.int64), 1, bins, mine, codes[where], y[rows], w[rows])[:, 0]
            pick, gain, _ = rule.best(sums, whole)
        out.append((node, int(pick), gain, *whole))
        if pick >= 0:
            left = rule.layout.goes_left(first, codes, rows, np.full(len(rows), pick))
            todo += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]
    return out


class Tree(Estimator):
    """Fits what the given classifier of Spark describes, for the labels 0 and 1."""

    def __init__(self, inner: DecisionTreeClassifier, local_rows: int = LOCAL_ROWS):
        super().__init__()
        self.inner, self.local_rows = inner, local_rows

    def _fit(self, df: DataFrame) -> DecisionTreeClassificationModel:
        p = self.inner
        weight = F.col(p.getWeightCol()).cast("double") if p.isDefined(p.weightCol) and p.getWeightCol() else F.lit(1.0)
        frame = df.select(unwrapped(df, p.getFeaturesCol()).alias("x"), F.col(p.getLabelCol()).cast("double").alias("y"), weight.alias("w"))
        n, bad = frame.agg(F.count(F.lit(1)), F.count_if(~F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False)))).first()
        if not n or bad:
            raise ValueError("a tree needs rows, and the labels 0 and 1")
        layout = fit_layout(df, p.getFeaturesCol(), frame, n, p.getMaxBins())
        encoded = materialise(frame.mapInArrow(_encoder(layout), "codes array<int>, y double, w double"), "binned")
        rule = Rule(layout, p.getImpurity(), p.getMinInstancesPerNode())
        return self._model(df, layout, rule, self._grow(encoded, rule, n, p.getMaxDepth()))

    def _grow(self, encoded: DataFrame, rule: Rule, n: int, depth: int) -> dict[int, tuple]:
        """Nodes by their number in a heap: (candidate, gain, class 0, class 1, rows)."""
        nodes: dict[int, tuple] = {}
        splits: dict[int, int] = {}
        local: list[int] = [1] if n <= self.local_rows else []
        live = [] if local else [1]
        step = max(1, HELD_SUMS // max(1, int(rule.layout.start[-1])))
        while live:
            found = [r for a in range(0, len(live), step) for r in self._splits(encoded, rule, dict(splits), live[a : a + step])]
            live = []
            for r in sorted(found, key=lambda r: r["node"]):
                whole = (r["n0"], r["n1"], r["n"])
                open_ = r["at"] >= 0 and r["node"].bit_length() - 1 < depth and not rule.pure(np.array(whole))
                nodes[r["node"]] = (r["at"] if open_ else -1, r["gain"] if open_ else 0.0, *whole)
                if open_:
                    splits[r["node"]] = r["at"]
                    for child, rows in ((2 * r["node"], r["n"] - r["r"]), (2 * r["node"] + 1, r["r"])):
                        (live if rows > self.local_rows else local).append(child)
        if local:
            nodes |= {r["node"]: (r["at"], r["gain"], r["n0"], r["n1"], r["n"]) for r in self._local(encoded, rule, splits, local, depth).collect()}  # the model
        return nodes

    def _splits(self, encoded: DataFrame, rule: Rule, splits: dict[int, int], nodes: list[int]) -> list:
        """The best split of each of the nodes, one small row per node."""
        names, bins = np.array(nodes, np.int64), int(rule.layout.start[-1])

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, whole = np.zeros((3, len(names), bins)), np.zeros((3, len(names)))
            for b in gathered(batches, len(names) * bins // 32):
                first, codes, y, w = _parts(b)
                node = route(rule.layout, splits, first, codes)
                at = np.minimum(np.searchsorted(names, node), len(names) - 1)
                at[names[at] != node] = -1
                sums += _counts(at, len(names), bins, first, codes, y, w)
                mine = at >= 0
                whole += np.stack([np.bincount(at[mine], v[mine], len(names)) for v in (w * (1 - y), w * y, np.ones(len(y)))])
            for i, node in enumerate(names):  # a node's own counts come as bin -1
                at = np.flatnonzero(sums[2, i])
                if whole[2, i]:
                    yield pa.RecordBatch.from_pydict({"node": np.full(len(at) + 1, node), "bin": np.concatenate([[-1], at]), **{k: np.concatenate([whole[j, i : i + 1], sums[j, i, at]]) for j, k in enumerate(("c0", "c1", "n"))}})

        def best(t: pd.DataFrame) -> pd.DataFrame:
            own = t["bin"] < 0
            whole = t.loc[own, ["c0", "c1", "n"]].to_numpy()[0]
            sums = np.zeros((3, bins))
            sums[:, t.loc[~own, "bin"]] = t.loc[~own, ["c0", "c1", "n"]].to_numpy().T
            pick, gain, left = rule.best(sums, whole)
            right = whole - left
            return pd.DataFrame([(t["node"].iloc[0], pick, gain, *whole, *right)], columns=["node", "at", "gain", "n0", "n1", "n", "r0", "r1", "r"])

        counts = encoded.mapInArrow(partial, "node long, bin long, c0 double, c1 double, n double").groupBy("node", "bin").agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "n")])
        return counts.groupBy("node").applyInPandas(best, _SPLITS).collect()

    def _local(self, encoded: DataFrame, rule: Rule, splits: dict[int, int], nodes: list[int], depth: int) -> DataFrame:
        names = np.array(sorted(nodes), np.int64)

        def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    node = route(rule.layout, splits, *_parts(b)[:2])
                    mine = np.isin(node, names)
                    yield pa.RecordBatch.from_arrays([pa.array(node), *b.columns], names=["node", *b.schema.names]).filter(pa.array(mine))

        def grown(t: pa.Table) -> pa.Table:
            rows = grow_local(t.column("node")[0].as_py(), t, rule, depth)
            columns = dict(zip(("node", "at", "gain", "n0", "n1", "n"), map(list, zip(*rows))))
            return pa.table({"node": pa.array(columns["node"], pa.int64()), "at": pa.array(columns["at"], pa.int64()),
                             **{c: pa.array(columns[c], pa.float64()) for c in ("gain", "n0", "n1")}, "n": pa.array([int(v) for v in columns["n"]], pa.int64())})

        rows = encoded.mapInArrow(routed, "node long, codes array<int>, y double, w double")
        return rows.groupBy("node").applyInArrow(grown, _GROWN)

    def _model(self, df: DataFrame, layout: Layout, rule: Rule, nodes: dict[int, tuple]) -> DecisionTreeClassificationModel:
        """The nodes in the form in which Spark saves a tree, read by Spark; parameters are those of the given classifier."""
        spark, p = df.sparkSession, self.inner
        leaf = {i for i, v in nodes.items() if v[0] < 0}
        says = {i: float(v[3] > v[2]) for i, v in nodes.items()}
        for i in sorted(set(nodes) - leaf, reverse=True):  # as Spark does: two leaves of one class become one
            if 2 * i in leaf and 2 * i + 1 in leaf and says[2 * i] == says[2 * i + 1]:
                leaf.add(i)
        order, todo = [], [1]
        while todo:
            i = todo.pop()
            order.append(i)
            if i not in leaf:
                todo += [2 * i + 1, 2 * i]
        number = {i: k for k, i in enumerate(order)}
        rows = []
        for i in order:
            pick, gain, a, b, n = nodes[i]
            own = (number[i], says[i], float(impurity(rule.kind, np.float64(a), np.float64(b))), [float(a), float(b)], int(n))
            if i in leaf:
                rows.append((*own, -1.0, -1, -1, (-1, [], -1)))
            else:
                of = int(layout.of[pick])
                cut = 0.5 if layout.cuts[of] is None else float(layout.cuts[of][layout.at[pick] - layout.start[of]])
                rows.append((*own, float(gain), number[2 * i], number[2 * i + 1], (int(layout.slots[of]), [cut], -1)))
        empty = Vectors.sparse(layout.width, {})
        pattern = spark.createDataFrame([(empty, y, 1.0) for y in (0.0, 1.0)], [p.getFeaturesCol(), p.getLabelCol(), p.getWeightCol() if p.isDefined(p.weightCol) and p.getWeightCol() else "_w"])
        folder, made = scratch_path(spark, "pattern"), scratch_path(spark, "tree")
        p.fit(pattern).write().save(folder)
        spark.read.text(f"{folder}/metadata").coalesce(1).write.text(f"{made}/metadata")
        spark.createDataFrame(rows, spark.read.parquet(f"{folder}/data").schema).write.parquet(f"{made}/data")
        return DecisionTreeClassificationModel.load(made)


def _encoder(layout: Layout) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                first, codes = layout.encode(rows_of(b.column("x")))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(codes, pa.int32())), b.column("y"), b.column("w")], names=["codes", "y", "w"])

    return encode


def fit_layout(df: DataFrame, features: str, frame: DataFrame, n: int, bins: int) -> Layout:
    """One pass tells 0/1 slots from numeric ones, a second counts the values of the numeric ones."""
    def kinds(x: Rows, b: pa.RecordBatch) -> dict[str, np.ndarray]:
        return {"odd": np.bincount(x.slot, (x.value != 0) & (x.value != 1), x.width), "filled": np.bincount(x.slot, x.value != 0, x.width)}

    got = slot_sums(df, features, kinds, ["odd", "filled"])
    width = len(got["odd"])
    numeric = np.flatnonzero(got["odd"] > 0)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, w = rows_of(b.column("x")), np.asarray(b.column("w"))
                dense = columns_of(x, x.row, numeric, width)
                for j, slot in enumerate(numeric):
                    v, at = np.unique(dense[:, j], return_inverse=True)
                    yield pa.RecordBatch.from_pydict({"slot": np.full(len(v), slot), "value": v, "n": np.bincount(at, w)})

    def wide(batches: Iterator[pa.RecordBatch], slots: np.ndarray) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = rows_of(b.column("x"))
                yield pa.RecordBatch.from_pydict({f"v{s}": v for s, v in zip(slots, columns_of(x, x.row, slots, width).T.copy())})

    cuts: dict[int, np.ndarray | None] = {}
    most = min(bins, n)
    if len(numeric):
        counts = materialise(frame.mapInArrow(values, "slot long, value double, n double").groupBy("slot", "value").agg(F.sum("n").alias("n")), "values")
        sizes = {r["slot"]: r["k"] for r in counts.groupBy("slot").agg(F.count(F.lit(1)).alias("k")).collect()}
        few = [s for s, k in sizes.items() if k <= VALUES]
        seen = counts.where(F.col("slot").isin(few)).toPandas().sort_values("value")  # VALUES rows per numeric slot at most
        for s, t in seen.groupby("slot"):
            cuts[s] = spark_cuts(t["value"].to_numpy(), t["n"].to_numpy(), most)
        many = np.array(sorted(set(sizes) - set(cuts)), np.int64)
        if len(many):
            dense = frame.mapInArrow(lambda it: wide(it, many), ", ".join(f"v{s} double" for s in many))
            found = dense.agg(*[F.percentile_approx(f"v{s}", [k / most for k in range(1, most)], 10_000).alias(f"v{s}") for s in many]).first()
            cuts |= {s: np.array(sorted(set(found[f"v{s}"]))) for s in many}
    cuts |= {s: None for s in np.flatnonzero((got["odd"] == 0) & (got["filled"] > 0) & (got["filled"] < n))}
    slots = sorted(s for s, c in cuts.items() if c is None or len(c))
    return Layout(np.array(slots, np.int64), [cuts[s] for s in slots], width)
