"""Regression trees over a few numeric columns, fitted on counted cells instead of rows.

A tree of at most 64 bins per column cannot tell two rows of one combination of bins (a cell) apart, and with squared loss it
needs of them only how many there are and their mean. So the rows are binned and counted once, whatever their number, and
all trees are grown on the cells: for boosting by Spark's own regressor with the counts as weights, for a forest with one
bootstrap of the rows per tree, counted by cells in the same pass.

Scale: one pass for the values, one for the counts. Columns with many values give many cells, never more than rows."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.session import materialise
from staymill.operators.forest import POISSON
from staymill.plans.barrier import uniform

BINS = 64
CELL_ROWS = 20_000  # cells of a task
HELD_ROWS = 200_000  # rows that are counted at once
HELD_SUMS = 4_000_000  # sums by cell and tree that a task keeps before it hands them on
CELLS = "_cells"


def fit_cuts(df: DataFrame, features: str, bins: int = BINS) -> list[list[float]]:
    """Per column the bounds of its bins: midway between neighbouring values if these are few, else at quantiles."""
    frame = df.select(vector_to_array(features).alias("x"))
    values = materialise(frame.select(F.posexplode("x").alias("slot", "value")).distinct(), "values")
    counts = {r["slot"]: r["n"] for r in values.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    few = [i for i, n in counts.items() if n <= bins]
    seen: dict[int, list[float]] = {i: [] for i in few}
    for r in values.where(F.col("slot").isin(few)).collect():  # `bins` values per column at most
        seen[r["slot"]].append(r["value"])
    cuts = {i: [(a + b) / 2 for a, b in zip(sorted(v), sorted(v)[1:])] for i, v in seen.items()}
    if many := [i for i in counts if i not in seen]:
        probs = [k / bins for k in range(1, bins)]
        got = frame.agg(*[F.percentile_approx(F.col("x")[i], probs, 10_000).alias(f"q{i}") for i in many]).first()
        cuts |= {i: sorted(set(got[f"q{i}"])) for i in many}
    return [cuts[i] for i in sorted(cuts)]


def coded(df: DataFrame, features: str, cuts: list[list[float]]) -> DataFrame:
    """The rows with the bin of every column, as columns `_b0`, `_b1`, ..."""
    inner, outer = [f"_x{i}" for i in range(len(cuts))], codes_of(cuts)
    x = vector_to_array(features)
    wide = df.withColumns({c: x[i] for i, c in enumerate(inner)})
    stage = Bucketizer(splitsArray=[[-math.inf, *(c or [0.0]), math.inf] for c in cuts], inputCols=inner, outputCols=outer)
    # As plain numbers: Bucketizer marks its columns as categories, whose bins trees would put in any order.
    return stage.transform(wide).drop(*inner).withColumns({c: F.col(c).cast("int") for c in outer})


def codes_of(cuts: list[list[float]]) -> list[str]:
    return [f"_b{i}" for i in range(len(cuts))]


def assembled(df: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """The bins as one vector column."""
    return VectorAssembler(inputCols=codes_of(cuts), outputCol=CELLS).transform(df).drop(*codes_of(cuts))


class CellModel(Model):
    """A model of the bins, with the bins."""

    def __init__(self, cuts: list[list[float]], inner: Model, features: str):
        super().__init__()
        self.cuts, self.inner, self.features = cuts, inner, features

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.inner.transform(assembled(coded(df, self.features, self.cuts), self.cuts)).drop(CELLS)


class CellRegressor(Estimator):
    """Spark's own tree regressor, fitted on cells weighted by their rows. For regressors that draw no rows."""

    def __init__(self, inner: Estimator, features: str = "features", label: str = "label"):
        super().__init__()
        self.inner, self.features, self.label = inner, features, label

    def _fit(self, df: DataFrame) -> CellModel:
        cuts = fit_cuts(df, self.features)
        counted = coded(df, self.features, cuts).groupBy(codes_of(cuts)).agg(F.avg(self.label).alias(self.label), F.count(F.lit(1)).cast("double").alias("_n"))
        counted = materialise(counted, "cells")
        cells = assembled(counted.repartition(max(1, math.ceil(counted.count() / CELL_ROWS)), *codes_of(cuts)), cuts)
        return CellModel(cuts, self.inner.copy({self.inner.featuresCol: CELLS, self.inner.weightCol: "_n"}).fit(cells), self.features)


# --- Forest -------------------------------------------------------------------------


@dataclass
class _Tree:
    """Flat nodes; a bin of `slot` up to `at` goes left, `left` is -1 at leaves."""

    slot: list[int] = field(default_factory=list)
    at: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)


def grow(codes: np.ndarray, n: np.ndarray, total: np.ndarray, depth: int, tried: int, rng: np.random.Generator) -> _Tree:
    """A tree of least squares over cells with `n` rows whose labels add up to `total`; every node tries `tried` drawn columns."""
    out = _Tree()

    def node(rows: np.ndarray, level: int) -> int:
        here, w, s = len(out.slot), n[rows].sum(), total[rows].sum()
        for column, v in ((out.slot, -1), (out.at, -1), (out.left, -1), (out.right, -1), (out.value, s / w)):
            column.append(v)
        best = (1e-12 * max(abs(s * s / w), 1e-300), -1, -1)  # what is within rounding is no gain
        for j in sorted(rng.choice(codes.shape[1], tried, replace=False)) if level < depth else ():
            wl = np.cumsum(np.bincount(codes[rows, j], n[rows]))[:-1]
            sl = np.cumsum(np.bincount(codes[rows, j], total[rows]))[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((wl > 0) & (wl < w), sl * sl / wl + (s - sl) ** 2 / (w - wl) - s * s / w, 0.0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), j, int(gain.argmax()))
        if best[1] >= 0:
            goes = codes[rows, best[1]] <= best[2]
            out.slot[here], out.at[here] = int(best[1]), best[2]
            out.left[here], out.right[here] = node(rows[goes], level + 1), node(rows[~goes], level + 1)
        return here

    node(np.flatnonzero(n > 0), 0)
    return out


_DRAWN = "tree int, cell binary, n double, total double"
_NODES = "tree int, slot array<int>, at array<int>, left array<int>, right array<int>, value array<double>"


def _unique(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of the codes, and which of them each row is."""
    found, at = np.unique(np.ascontiguousarray(codes).view(f"V{codes.shape[1]}").ravel(), return_inverse=True)
    return found.view(np.uint8).reshape(-1, codes.shape[1]), at


def _draws(batches: Iterator[pa.RecordBatch], trees: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(tree, cell, n, total): by tree and cell how many rows its bootstrap draws, and the sum of their labels."""
    cells, sums = np.zeros((0, 0), np.uint8), np.zeros((0, 2, trees))

    def counted(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held)
        codes = np.stack([np.asarray(table.column(c)) for c in table.column_names if c.startswith("_b")], axis=1).astype(np.uint8)
        y, key = np.asarray(table.column("y")), np.asarray(table.column("k"))
        found, at = _unique(codes)
        got = np.empty((len(found), 2, trees))
        for t in range(trees):
            n = np.searchsorted(POISSON, uniform(key, seed * 100_003 + t), side="right")
            got[:, 0, t], got[:, 1, t] = np.bincount(at, n, len(found)), np.bincount(at, n * y, len(found))
        return found, got

    def flushed() -> Iterator[pa.RecordBatch]:
        if not len(cells):
            return
        texts = np.array([c.tobytes() for c in cells], object)
        for t in range(trees):
            some = np.flatnonzero(sums[:, 0, t])
            yield pa.RecordBatch.from_pydict({"tree": pa.array(np.full(len(some), t), pa.int32()), "cell": pa.array(texts[some], pa.binary()), "n": sums[some, 0, t], "total": sums[some, 1, t]})

    held: list[pa.RecordBatch] = []
    for b in itertools.chain(batches, [None]):
        if b is not None:
            held.append(b)
        if held and (b is None or sum(map(len, held)) >= HELD_ROWS):
            one, got = counted(held)
            held = []
            if len(cells):
                one, at = _unique(np.concatenate([cells, one]))
                both = np.zeros((len(one), 2, trees))
                both[at[: len(cells)]] = sums
                both[at[len(cells) :]] += got
                got = both
            cells, sums = one, got
            if sums.size > HELD_SUMS:
                yield from flushed()
                cells, sums = cells[:0], sums[:0]
    yield from flushed()


class CellForest(Estimator):
    """Regression forest: every tree has a bootstrap of the rows (Poisson counts of a hash of their keys) and every node tries a
    third of the columns, as Spark's forest does; a prediction is the mean over the trees."""

    def __init__(self, trees: int = 200, depth: int = 6, features: str = "features", label: str = "label", key: str = "id", seed: int = S.SEED):
        super().__init__()
        self.trees, self.depth, self.features, self.label, self.key, self.seed = trees, depth, features, label, key, seed

    def _fit(self, df: DataFrame) -> CellForestModel:
        cuts = fit_cuts(df, self.features)
        trees, depth, seed, tried = self.trees, self.depth, self.seed, math.ceil(len(cuts) / 3)
        key = F.xxhash64(self.key) if self.key in df.columns else F.monotonically_increasing_id()
        rows = coded(df, self.features, cuts).select(*codes_of(cuts), F.col(self.label).cast("double").alias("y"), key.alias("k"))
        counts = rows.mapInArrow(lambda it: _draws(it, trees, seed), _DRAWN).groupBy("tree", "cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

        def one(t: pd.DataFrame) -> pd.DataFrame:
            t = t.sort_values("cell")  # sums do not depend on the order of arrival
            codes = np.frombuffer(b"".join(t["cell"]), np.uint8).reshape(len(t), -1)
            number = int(t["tree"].iloc[0])
            tree = grow(codes, t["n"].to_numpy(), t["total"].to_numpy(), depth, tried, np.random.default_rng([seed, number]))
            return pd.DataFrame({"tree": [number], **{k: [v] for k, v in vars(tree).items()}})

        grown = materialise(counts.groupBy("tree").applyInPandas(one, _NODES), "trees")
        made = [_Tree(*[list(r[k]) for k in ("slot", "at", "left", "right", "value")]) for r in grown.orderBy("tree").collect()]  # the model
        return CellForestModel(cuts, made, self.features)


class CellForestModel(Model):
    def __init__(self, cuts: list[list[float]], trees: list[_Tree], features: str):
        super().__init__()
        self.cuts, self.trees, self.features = cuts, trees, features

    def _transform(self, df: DataFrame) -> DataFrame:
        names = codes_of(self.cuts)
        held = df.sparkSession.sparkContext.broadcast([{k: np.array(v) for k, v in vars(t).items()} for t in self.trees])

        @F.pandas_udf("double")
        def predicted(*columns: pd.Series) -> pd.Series:
            cells, at = _unique(np.stack([c.to_numpy() for c in columns], axis=1).astype(np.uint8))
            out = np.zeros(len(cells))
            for t in held.value:
                node, live = np.zeros(len(cells), np.int64), np.arange(len(cells))
                while len(live := live[t["left"][node[live]] >= 0]):
                    n = node[live]
                    node[live] = np.where(cells[live, t["slot"][n]] <= t["at"][n], t["left"][n], t["right"][n])
                out += t["value"][node]
            return pd.Series(out[at] / max(len(held.value), 1))

        return coded(df, self.features, self.cuts).withColumn("prediction", predicted(*names)).drop(*names)
