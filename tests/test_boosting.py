"""Boosting against a plain booster on 500 rows, any number of tasks, and its stored form."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from staymill.operators import boosting as B


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    n = 500
    num = np.c_[rng.integers(0, 30, n), rng.integers(-10, 11, n) / 8, rng.integers(0, 2, n)].astype(float)
    kind = rng.integers(0, 5, n)
    hot = np.eye(5)[kind]
    hot[kind == 4] = 0  # an unseen level: nothing filled
    x = np.c_[num, hot[:, :4]]
    y = (rng.random(n) < 1 / (1 + np.exp(-(num[:, 0] / 10 - 1.5 + num[:, 1] + 2 * hot[:, 1])))).astype(float)
    return x, y, rng.integers(1, 4, n).astype(float)


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y, w = rows
    return spark.createDataFrame([(i, a.tolist(), float(b), float(c)) for i, (a, b, c) in enumerate(zip(*rows))], "booking_id long, x array<double>, label double, weight double").repartition(3).withColumn("features", array_to_vector("x")).drop("x")


def _plain(x, y, w, trees, depth, rate, ridge=1.0, least=1.0):
    """Exact greedy boosting, node by node, over all distinct cuts."""
    margin = np.full(len(y), np.log(np.average(y, weights=w) / (1 - np.average(y, weights=w))))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def grow(rows, level):
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-9, None)
            if level < depth:
                for j in range(x.shape[1]):
                    for cut in np.unique(x[rows, j])[:-1]:
                        low = rows[x[rows, j] <= cut]
                        gl, hl = g[low].sum(), h[low].sum()
                        if min(hl, hs - hl) >= least:
                            gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                            if gain > best[0] + 1e-7:
                                best = (gain, x[rows, j] <= cut)
            if best[1] is None:
                margin[rows] -= rate * gs / (hs + ridge)
            else:
                grow(rows[best[1]], level + 1)
                grow(rows[~best[1]], level + 1)

        grow(np.arange(len(y)), 0)
    return margin


def test_equals_a_plain_booster(frame, rows):
    x, y, w = rows
    s = B.Settings(5, 4, 0.3, 1.0, 1.0)
    for weight, ws in ((None, np.ones(len(y))), ("weight", w)):
        model = B.Boosting(s, weight=weight, bins=256).fit(frame)
        assert np.allclose(model.margins(x), _plain(x, y, ws, 5, 4, 0.3), atol=1e-4)


def test_bundles_are_the_one_hot_groups(frame, rows):
    from pyspark.ml.functions import vector_to_array

    bins = B.fit_bins(frame.select(vector_to_array("features").alias("x")), 16)
    assert bins.bundles == [(0, 1), (1, 2), (2, 3), (3, 7)] and [c is None for c in bins.cuts] == [False, False, True, True]
    assert (bins.encode(rows[0])[:, 3] == np.where(rows[0][:, 3:].any(axis=1), rows[0][:, 3:].argmax(axis=1) + 1, 0)).all()


def test_trees_do_not_depend_on_the_number_of_tasks(frame):
    fits = [B.Boosting(B.Settings(6, 5, 0.2, 0.8, 0.7), tasks=t).fit(frame.repartition(p)) for t, p in ((1, 2), (3, 5))]
    for a, b in zip(fits[0].trees, fits[1].trees):
        assert all((a[k] == b[k]).all() for k in ("feature", "threshold", "left", "right", "value", "cover"))
        assert a["loss"] == b["loss"]


def test_blocks_of_nodes_change_nothing(rows, monkeypatch):
    x, y, w = rows
    bins = B.Bins([(i, i + 1) for i in range(3)] + [(3, 7)], [sorted(set(x[:, 0]))[:-1], sorted(set(x[:, 1]))[::9], None, None])

    def fit():
        return B.train(bins.encode(x), y, w, np.zeros(len(y), bool), np.arange(len(y)), bins, B.Settings(5, 6, 0.2, 0.9, 0.9), lambda v: [v])[1]

    whole = fit()
    monkeypatch.setattr(B, "KEPT_SUMS", 200)
    monkeypatch.setattr(B, "BLOCK_SUMS", 50)
    for a, b in zip(whole, fit()):
        assert all((a[k] == b[k]).all() for k in ("feature", "left", "right")) and np.allclose(a["value"], b["value"])


def test_stops_at_the_best_validation_loss(frame):
    held = frame.withColumn("held", F.col("booking_id") % 4 == 0)
    model = B.Boosting(B.Settings(80, 6, 0.5, 1.0, 1.0, patience=5), validation="held").fit(held)
    losses = [t["held_loss"] for t in model.trees]
    assert len(losses) < 80 and losses[-1] == min(losses)
    curve = model.evaluateEachIteration(held.where("held"))
    assert np.allclose(curve, losses, atol=1e-5)


def test_model_transforms_and_comes_back(frame, rows, tmp_path):
    model = B.Boosting(B.Settings(4, 3, 0.3, 1.0, 1.0)).fit(frame)
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    got = again.transform(frame).orderBy("booking_id").collect()
    p = 1 / (1 + np.exp(-model.margins(rows[0])))
    assert np.allclose([r["probability"][1] for r in got], p) and [r["prediction"] for r in got] == (p > 0.5).astype(float).tolist()
    assert again.transform(frame.limit(0)).count() == 0


def test_one_class_only(frame):
    model = B.Boosting(B.Settings(3, 3, 0.3, 1.0, 1.0)).fit(frame.withColumn("label", F.lit(1.0)))
    assert {r["prediction"] for r in model.transform(frame).collect()} == {1.0}
