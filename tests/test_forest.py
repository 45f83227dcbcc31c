"""The forest against plain counting on small rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from staymill.operators import boosting as B
from staymill.operators import forest as FO
from staymill.plans.barrier import uniform

ALONE = lambda v: [v]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    n = 400
    kind = rng.integers(0, 4, n)  # a one-hot group of three slots beside two numbers
    x = np.c_[rng.integers(0, 12, n), rng.normal(size=n).round(1), *[(kind == k) for k in range(3)]].astype(float)
    y = (rng.random(n) < np.where(kind == 1, 0.8, 0.2 + 0.03 * x[:, 0])).astype(float)
    return x, y, np.arange(n) * 7919


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y, k = rows
    made = spark.createDataFrame([(int(i), float(t), a.tolist()) for i, t, a in zip(k, y, x)], "booking_id bigint, label double, v array<double>")
    return made.withColumn("features", array_to_vector("v")).drop("v")


def bins_of(x):
    return B.Bins([(0, 1), (1, 2), (2, 5)], [sorted(set(x[:, 0]))[:-1], sorted(set(x[:, 1]))[:-1], None])


def test_root_split_lowers_gini_most(rows):
    x, y, k = rows
    bins = bins_of(x)
    settings = FO.ForestSettings(6, 1, 1 / 6, 1.0, 1.0, ridge=0.0, min_hessian=5.0)
    _, trees = FO.train_forest(bins.encode(x), y, np.ones(len(y)), np.zeros(len(y), bool), k, bins, settings, ALONE)

    def impurity(count, mask):
        n = count[mask].sum()
        p = (count * y)[mask].sum() / n if n else 0.0
        return n * 2 * p * (1 - p)

    for t, tree in enumerate(trees):
        count = np.searchsorted(FO.POISSON, uniform(k, settings.seed * 100_003 + t), side="right")
        assert abs(count.mean() - 1) < 0.15 and count.max() >= 3
        scores = {}
        for j in range(5):
            for cut in ([0.5] if j > 1 else sorted(set(x[:, j]))[:-1]):
                left = x[:, j] <= cut
                if min(count[left].sum(), count[~left].sum()) >= 5:
                    scores[j, cut] = impurity(count, left) + impurity(count, ~left)
        got = scores[int(tree["feature"][0]), float(tree["threshold"][0])]
        assert got == pytest.approx(min(scores.values()), abs=1e-6)
        left = x[:, tree["feature"][0]] <= tree["threshold"][0]
        for side, mask in ((tree["left"][0], left), (tree["right"][0], ~left)):
            assert tree["value"][side] * 6 == pytest.approx((count * y)[mask].sum() / count[mask].sum())
            assert tree["cover"][side] == pytest.approx(count[mask].sum())


def test_leaves_are_large_enough_and_features_are_drawn(rows):
    x, y, k = rows
    bins = bins_of(x)
    settings = FO.ForestSettings(30, 12, 1 / 30, 1.0, 1.0, ridge=0.0, min_hessian=10.0, features=1)
    _, trees = FO.train_forest(bins.encode(x), y, np.ones(len(y)), np.zeros(len(y), bool), k, bins, settings, ALONE)
    assert all((t["cover"][t["left"] < 0] >= 10).all() for t in trees)
    assert len({int(t["feature"][0]) for t in trees}) >= 4  # one slot per node: roots differ
    p = FO.ForestModel(trees).margins(x)
    assert (p >= 0).all() and (p <= 1).all() and p[y == 1].mean() > p[y == 0].mean() + 0.1


def test_one_class_and_no_signal_give_single_leaves(rows):
    x, _, k = rows
    bins = bins_of(x)
    settings = FO.ForestSettings(3, 5, 1 / 3, 1.0, 1.0, ridge=0.0, min_hessian=1.0)
    _, trees = FO.train_forest(bins.encode(x), np.ones(len(x)), np.ones(len(x)), np.zeros(len(x), bool), k, bins, settings, ALONE)
    assert all(len(t["left"]) == 1 for t in trees) and np.allclose(FO.ForestModel(trees).margins(x), 1.0)


def test_fit_save_load_and_importance(spark, frame, rows, tmp_path):
    model = FO.Forest(8, 6, 5, "sqrt").fit(frame)
    assert model.getNumTrees == 8 and model.featureImportances.toArray().sum() == pytest.approx(1.0)
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert type(again) is FO.ForestModel
    scored = [m.transform(frame).orderBy("booking_id").select("probability", "prediction").collect() for m in (model, again)]
    assert scored[0] == scored[1]
    x, _, k = rows
    p = model.margins(x[np.argsort(k)])
    assert np.allclose([r["probability"][1] for r in scored[0]], p)
    assert [r["prediction"] for r in scored[0]] == (p > 0.5).astype(float).tolist()


def test_weights_move_the_shares(frame):
    heavy = frame.withColumn("w", F.when(F.col("label") == 1, 4.0).otherwise(1.0))
    plain, weighted = FO.Forest(6, 4, 5, "all").fit(heavy), FO.Forest(6, 4, 5, "all", weight="w").fit(heavy)
    mean = lambda m: sum(r["probability"][1] for r in m.transform(heavy).select("probability").collect())
    assert mean(weighted) > 1.3 * mean(plain)


def test_trees_do_not_depend_on_the_number_of_tasks(frame):
    one, two = (FO.Forest(2, 2, 5, "sqrt", tasks=n).fit(frame) for n in (1, 2))
    for a, b in zip(one.trees, two.trees):
        assert all(np.array_equal(a[c], b[c]) for c in ("feature", "threshold", "left", "right", "value", "cover"))
