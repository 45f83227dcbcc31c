"""The network against finite differences, one task against several, early stop, stored form."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array

from staymill.operators import network as N


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    y = (rng.random(500) < 1 / (1 + np.exp(-(x[:, 0] * x[:, 1] * 2 + x[:, 2])))).astype(float)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y = rows
    df = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "booking_id long, x array<double>, label double")
    return df.repartition(3).select("booking_id", "label", array_to_vector("x").alias("features"))


def test_gradient_equals_differences(rows):
    x, y = rows[0][:20].astype(float), rows[1][:20]
    layers = N.start(6, N.Settings(hidden=(5, 4, 3)))
    mask = (np.random.default_rng(1).random((20, 5)) > 0.3) / 0.7
    p, like = N._flat(layers), layers

    def loss(q):
        m = N.forward(N._shaped(q, like), x, mask)[-1][:, 0]
        return (np.logaddexp(0, m) - y * m).sum()

    got = N.gradient(layers, x, y, mask)
    for i in range(0, len(p), 3):
        e = np.zeros_like(p)
        e[i] = 1e-6
        assert abs((loss(p + e) - loss(p - e)) / 2e-6 - got[i]) < 1e-4


def test_any_number_of_tasks(frame):
    s = N.Settings(hidden=(8, 4), epochs=4, batch=64)
    a, b = (N.Network(s, tasks=t).fit(frame) for t in (1, 3))
    assert np.allclose(N._flat(a.layers), N._flat(b.layers), atol=1e-9) and np.allclose(a.history, b.history)


def test_tasks_meet_without_waiting(frame):
    """Some 60 meetings; `allGather` waits up to a second for each."""
    import time

    begun = time.perf_counter()
    N.Network(N.Settings(hidden=(8, 4), epochs=8, batch=64), tasks=2).fit(frame)
    assert time.perf_counter() - begun < 25


def test_stops_and_keeps_the_best(frame, rows):
    model = N.Network(N.Settings(hidden=(32, 16), epochs=300, batch=64, rate=0.02, patience=6)).fit(frame)
    losses, checks = zip(*model.history)
    best = checks.index(min(checks))
    assert losses[-1] < losses[0] and len(checks) < 300 and len(checks) - 1 - best == 6
    held = [r[0] for r in frame.select("booking_id").where(N.held_out()).collect()]
    assert 60 < len(held) < 140
    m = N.forward(model.layers, rows[0][held])[-1][:, 0]
    assert abs((np.logaddexp(0, m) - rows[1][held] * m).mean() - checks[best]) < 1e-9


def test_comes_back(frame, tmp_path):
    model = N.Network(N.Settings(hidden=(4,), epochs=2)).fit(frame)
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (m.transform(frame).orderBy("booking_id").select("probability", "prediction").collect() for m in (model, again))
    assert a == b and again.stages[0].history == model.history and again.transform(frame.limit(0)).count() == 0


def test_wide_rows_are_kept_by_their_filled_slots(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(5)
    hot = rng.integers(0, 3000, 300)
    rows = [(i, float(h % 2), Vectors.sparse(3000, [int(h)], [1.0])) for i, h in enumerate(hot)]
    df = spark.createDataFrame(rows, ["booking_id", "label", "features"])
    sizes = []
    monkeypatch.setattr(N, "tasks_for", lambda packed, size, each: sizes.append(size) or 1)
    s = N.Settings(hidden=(8, 4), epochs=3, batch=64)
    model = N.Network(s).fit(df)
    assert sizes[0] <= 300 * 40  # 3.6 MB as dense rows
    dense = df.select("booking_id", "label", array_to_vector(vector_to_array("features")).alias("features"))
    other = N.Network(s).fit(dense)
    assert np.allclose(N._flat(model.layers), N._flat(other.layers), atol=1e-9) and np.allclose(model.history, other.history)
    x = np.zeros((300, 3000), np.float32)
    x[np.arange(300), hot] = 1
    p = [r["probability"][1] for r in model.transform(df).orderBy("booking_id").collect()]
    assert np.allclose(p, 1 / (1 + np.exp(-N.forward(model.layers, x)[-1][:, 0])))
