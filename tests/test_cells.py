import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor

from staymill.operators import models as M
from staymill.operators.cells import CellForest, coded, fit_cuts, grow


def _rows(spark, n=3000, wide=False):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(1, 30, n), rng.integers(0, 7, n) / 100, rng.random(n) if wide else rng.integers(0, 5, n)], axis=1).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 0.03) * 9 + x[:, 2] + rng.normal(size=n)
    return spark.createDataFrame([(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["id", "label", "features"])


def _by_id(df):
    return np.array([r["prediction"] for r in df.orderBy("id").collect()])


def test_boosting_on_cells_equals_boosting_on_rows(spark):
    df = _rows(spark)
    fitted = M.boosting_regressor(maxDepth=3, maxIter=4).fit(df)
    rows = GBTRegressor(**M._IO, **M._TREE, maxDepth=3, maxIter=4).fit(df)
    assert np.allclose(_by_id(fitted.transform(df)), _by_id(rows.transform(df)))


def test_boosting_reads_cells_only(spark):
    """A thousand times the rows give the same trees from as many cells."""
    df = spark.createDataFrame([(float(i % 3), float(i % 5), Vectors.dense([i % 3, i % 2])) for i in range(30)], ["id", "label", "features"])
    more = df.crossJoin(spark.range(200).withColumnRenamed("id", "_n")).drop("_n")
    one, many = (M.boosting_regressor(maxDepth=2, maxIter=2).fit(d) for d in (df, more))
    assert np.allclose(_by_id(one.transform(df)), _by_id(many.transform(df)))
    assert many.inner.trees[0].numNodes == one.inner.trees[0].numNodes


@pytest.mark.parametrize("wide", [False, True])
def test_bins(spark, wide):
    df = _rows(spark, wide=wide)
    cuts = fit_cuts(df, "features")
    assert [len(c) for c in cuts[:2]] == [28, 6] and (55 < len(cuts[2]) < 64 if wide else len(cuts[2]) == 4)
    codes = [tuple(r) for r in coded(df, "features", cuts).select("_b0", "features").collect()]
    assert all(b == x[0] - 1 for b, x in codes)


def test_forest_counts_rows_not_cells(spark):
    """The bootstrap draws rows: a cell of many rows keeps its mean, whatever the draw of one count per cell would do."""
    rows = [(i, 10.0 if i < 2000 else 0.0, Vectors.dense([0.0 if i < 2000 else 1.0])) for i in range(4000)]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    model = CellForest(trees=8, depth=0).fit(df)
    assert all(abs(t.value[0] - 5.0) < 0.6 for t in model.trees) and len({t.value[0] for t in model.trees}) > 4
    assert np.allclose(sorted(set(_by_id(CellForest(trees=8, depth=1).fit(df).transform(df)))), [0.0, 10.0])


def test_forest_does_not_depend_on_partitions(spark):
    df = _rows(spark, 500)
    a, b = (_by_id(CellForest(trees=5, depth=3).fit(d).transform(df)) for d in (df.repartition(1), df.repartition(7)))
    assert np.allclose(a, b)
    label = np.array([r["label"] for r in df.orderBy("id").collect()])
    assert ((a - label) ** 2).mean() < label.var() / 2


def test_tree_takes_the_best_split():
    codes = np.array([[0, 0], [1, 0], [2, 1], [3, 1]], np.uint8)
    tree = grow(codes, np.ones(4), np.array([0.0, 0.0, 0.0, 8.0]), 1, 2, np.random.default_rng(0))
    assert tree.slot[0] == 0 and tree.at[0] == 2 and tree.value == [2.0, 0.0, 8.0]
