"""Random forest for two classes on the binned rows of `boosting`, all trees of a fit in one barrier job.

With squared loss the best split of the sums of labels and weights is the one that lowers the Gini impurity most, so the
growing is that of boosting: every tree weighs the rows by Poisson counts of a hash of their keys (a bootstrap that needs no
exchange of rows), every node draws the features it may use, and a leaf holds the class share of its rows. A model of many
trees is one job rather than one per group of nodes."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.operators.boosting import KEPT_SUMS, UNIT, Bins, Boosting, BoostingModel, Settings, _Dense, _Grower, _State
from staymill.plans.barrier import Gather, total, uniform

#: Chances that a Poisson count of mean 1 is at most 0, 1, ...
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])

LARGE = 4000  # drawn rows from which a node is counted on its own


@dataclass
class ForestSettings(Settings):
    features: int | None = None  # slots drawn per node; None: all


class _ForestGrower(_Grower):
    def begin(self) -> None:
        self.drawn, self.tops = 0, 1

    def divisible(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return super().divisible(g, h) & (g < 0) & (g > -h)  # both classes occur

    def ranks(self, st: _State, can: np.ndarray) -> tuple[np.ndarray | None, bool]:
        """Nodes are numbered in the order of the whole tree, so that they draw alike wherever they are grown."""
        width = self.bins.bundles[-1][1]
        if self.s.features is None or self.s.features >= width:
            return super().ranks(st, can)
        top = st.top[can]
        each = np.bincount(top, minlength=self.tops)
        if st.meet is not None:
            each = total(st.meet, each).astype(np.int64)
        ranks = self.drawn + (np.cumsum(each) - each)[top] + np.arange(len(top)) - np.searchsorted(top, top)
        self.drawn += int(each.sum())
        return ranks, not each.any()

    def forced(self, st: _State, dense: _Dense) -> bool:
        """A large node costs the few sums of the features it draws, so a tree may stay lopsided for long."""
        if self.s.features is None:
            return super().forced(st, dense)
        return 2 * int((st.totals[1] < LARGE * UNIT).sum()) * dense.bins > KEPT_SUMS

    def _search(self, st: _State, dense: _Dense, order, n, is_open, rows, at, totals, sums, ranks):
        """Large nodes are counted on their own, and only the bundles of the features that they draw."""
        if ranks is None:
            return super()._search(st, dense, order, n, is_open, rows, at, totals, sums, ranks)
        large = totals[1] >= LARGE * UNIT
        found = [np.full(totals.shape[1], -2.0), np.zeros(totals.shape[1], np.int64), np.zeros(totals.shape)]
        if not large.all():
            mine, place = ~large[at], np.cumsum(~large) - 1
            some, _ = super()._search(st, dense, order, n, is_open, rows[mine], place[at[mine]], totals[:, ~large], None, ranks[~large])
            for a, b in zip(found, some):
                a[..., ~large] = b
        if large.any():
            mine = large[at]
            rows, at = rows[mine], at[mine]
            by = np.argsort(at.astype(np.uint16) if len(large) < 1 << 16 else at, kind="stable")
            rows, edge = rows[by], np.searchsorted(at[by], [np.flatnonzero(large), np.flatnonzero(large) + 1])
            drawn, parts = [], []
            for i, a, b in zip(np.flatnonzero(large), *edge):
                c = np.flatnonzero(~self.barred(ranks[i : i + 1])[0][self.slot])
                drawn.append(c)
                here = rows[a:b]
                g, h = st.g[here], st.h[here]
                for k in np.unique(self.bundle[c]):
                    code = st.columns[k][here]
                    size = int(self.bins.first[k + 1] - self.bins.first[k])
                    parts.append(np.stack([np.bincount(code, v, minlength=size) for v in (g, h)]))
            sums, at = total(st.gather, np.concatenate(parts, axis=1)) if parts else np.zeros((2, 0)), 0
            for i, c in zip(np.flatnonzero(large), drawn):
                if not len(c):
                    continue
                kinds = np.unique(self.bundle[c])
                size = np.diff(self.bins.first)[kinds]
                start = np.zeros(len(self.bins.bundles), np.int64)
                start[kinds] = np.cumsum(size) - size
                part, whole = sums[:, at : at + size.sum()], totals[:, i : i + 1]
                at += int(size.sum())
                numeric = self.numeric[self.bundle[c]]
                c = np.concatenate([c[numeric], c[~numeric]])
                place, m = self.at[c] - self.start[c] + start[self.bundle[c]], int(numeric.sum())
                run = np.concatenate([np.zeros((2, 1)), np.cumsum(part, axis=1)], axis=1)
                low = whole - part[:, place]
                low[:, :m] = run[:, place[:m] + 1] - run[:, start[self.bundle[c[:m]]]]
                score = self._score(low / UNIT, whole / UNIT)
                top = int(score.argmax())
                found[0][i], found[1][i], found[2][:, i] = score[top], c[top], low[:, top]
        return found, None

    def barred(self, ranks: np.ndarray) -> np.ndarray:
        width = self.bins.bundles[-1][1]
        drawn = np.empty((len(ranks), width))
        for part in np.split(np.arange(len(ranks)), np.flatnonzero(np.diff(ranks) != 1) + 1):
            source = np.random.PCG64([self.s.seed, self.t])
            source.advance(int(ranks[part[0]]) * width)
            np.random.Generator(source).random(out=drawn[part[0] : part[-1] + 1])
        last = np.partition(drawn, self.s.features - 1, axis=1)[:, self.s.features - 1]
        return drawn > last[:, None]


def train_forest(codes: np.ndarray, y: np.ndarray, w: np.ndarray, held: np.ndarray, keys: np.ndarray, bins: Bins, settings: ForestSettings, gather: Gather) -> tuple[float, list[dict]]:
    """(0, trees), the same in every task; leaf values are shares over the number of trees, so a row's values add up to its probability."""
    grower = _ForestGrower(codes, bins, settings, gather)
    weight = np.rint(w * UNIT) * ~held
    trees = []
    for t in range(settings.trees):
        count = np.searchsorted(POISSON, uniform(keys, settings.seed * 100_003 + t), side="right")
        grower.t = t
        h = weight * count
        tree, _ = grower.grow(-h * y, h, h > 0, np.arange(len(grower.slot)))
        trees.append(tree | {"loss": None, "held_loss": None})
    return 0.0, trees


class Forest(Boosting):
    """Estimator over a vector column and a 0/1 label; `min_leaf` counts drawn rows by their weights."""

    def __init__(self, trees: int, max_depth: int, min_leaf: float, max_features: str, features: str = "features", label: str = "label",
                 weight: str | None = None, key: str = S.KEY, bins: int = 64, tasks: int | None = None, seed: int = S.SEED):
        settings = ForestSettings(trees, max_depth, 1.0 / trees, 1.0, 1.0, ridge=0.0, min_hessian=float(min_leaf), seed=seed)
        super().__init__(settings, features, label, weight, None, key, bins, tasks)
        self.max_features = max_features

    def getNumTrees(self) -> int:
        return self.settings.trees

    @property
    def model(self) -> type[ForestModel]:
        return ForestModel

    def trainer(self) -> Callable:
        return _Trainer(self.max_features)


@dataclass
class _Trainer:
    """Slots per node follow from the width, which the bins know."""

    max_features: str

    def __call__(self, codes, y, w, held, keys, bins: Bins, settings: ForestSettings, gather: Gather):
        width = bins.bundles[-1][1]
        settings.features = {"sqrt": max(1, int(math.sqrt(width))), "log2": max(1, int(math.log2(width))), "all": None}[self.max_features]
        return train_forest(codes, y, w, held, keys, bins, settings, gather)


class ForestModel(BoostingModel):
    """Trees whose leaf values add up to the probability of class 1."""

    def _judged(self, p: Column) -> dict[str, Column]:
        both = array_to_vector(F.array(1 - p, p))
        return {"rawPrediction": both, "probability": both, "prediction": (p > 0.5).cast("double")}

    def evaluateEachIteration(self, df, label: str = "label"):
        raise NotImplementedError("the trees of a forest do not follow one another")

    @property
    def featureImportances(self) -> DenseVector:
        """Mean over the trees of each feature's share of the impurity that the tree removes."""
        width = 1 + max((int(t["feature"].max()) for t in self.trees), default=-1)
        out = np.zeros(max(width, 0))
        for t in self.trees:
            spread = t["cover"] * t["value"] ** 2
            inner = np.flatnonzero(t["left"] >= 0)
            gain = spread[t["left"][inner]] + spread[t["right"][inner]] - spread[inner]
            if gain.sum() > 0:
                out += np.bincount(t["feature"][inner], gain, minlength=len(out)) / gain.sum() / len(self.trees)
        return DenseVector(out)
