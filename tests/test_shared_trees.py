"""Trees whose lower parts are grown by one task each, wide one-hot groups, and rows kept by their filled slots."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from staymill.functions.vectors import packed, rows_in
from staymill.operators import boosting as B
from staymill.operators import explain as X
from staymill.operators import forest as FO
from staymill.plans.barrier import Alone, Files

GROUP = 400


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    n = 3000
    kind = rng.integers(0, GROUP + 1, n)
    hot = np.zeros((n, GROUP))
    hot[kind < GROUP, kind[kind < GROUP]] = 1
    x = np.c_[rng.normal(size=(n, 2)).round(1), hot]
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + (kind % 7 == 0) * 2 - (kind % 5 == 0))))).astype(float)
    bins = B.Bins([(0, 1), (1, 2), (2, GROUP + 2)], [sorted(set(x[:, 0]))[:-1:2], sorted(set(x[:, 1]))[:-1:2], None])
    return bins, bins.encode(x), x, y, np.arange(n) * 7919


def _fit(rows, tasks, folder, train, settings):
    """Trees as every one of the tasks has them; the rows are dealt out unevenly."""
    bins, codes, _, y, k = rows

    def one(me):
        mine = np.minimum(np.arange(len(y)) % (tasks + 2), tasks - 1) == me
        gather = Files(str(folder), me, tasks) if tasks > 1 else Alone()
        return train(codes[mine], y[mine], np.ones(mine.sum()), np.zeros(mine.sum(), bool), k[mine], bins, settings(), gather)[1]

    with ThreadPoolExecutor(tasks) as pool:
        return list(pool.map(one, range(tasks)))


def _equal(a, b):
    return len(a) == len(b) and all(np.array_equal(s[c], t[c]) for s, t in zip(a, b) for c in ("feature", "threshold", "left", "right", "value", "cover"))


def test_boosting_is_the_same_however_it_is_shared(rows, tmp_path, monkeypatch):
    settings = lambda: B.Settings(4, 9, 0.3, 0.9, 0.8)
    (whole,) = _fit(rows, 1, tmp_path, B.train, settings)
    assert max(t["feature"].max() for t in whole) > 1 and len(whole[0]["left"]) > 60
    for tasks in (2, 3):
        for trees in _fit(rows, tasks, tmp_path / f"a{tasks}", B.train, settings):
            assert _equal(whole, trees)
    assert len(list((tmp_path / "a3").iterdir())) <= 3  # files of the last round only
    monkeypatch.setattr(B, "WIDE", 10**6)  # counted as any other bundle
    assert _equal(whole, _fit(rows, 1, tmp_path, B.train, settings)[0])


@pytest.mark.parametrize("features", [None, 15])
def test_forest_is_the_same_however_it_is_counted(rows, tmp_path, monkeypatch, features):
    settings = lambda: FO.ForestSettings(3, 10, 1 / 3, 1.0, 1.0, ridge=0.0, min_hessian=5.0, features=features)
    (whole,) = _fit(rows, 1, tmp_path, FO.train_forest, settings)
    assert sum(len(t["left"]) for t in whole) > 20
    for i, large in enumerate((1, 100, 10**9)):
        monkeypatch.setattr(FO, "LARGE", large)
        for tasks in (1, 3):
            for trees in _fit(rows, tasks, tmp_path / f"{i}-{tasks}", FO.train_forest, settings):
                assert _equal(whole, trees)


def test_wide_rows_cost_their_filled_slots(spark, monkeypatch):
    rng = np.random.default_rng(5)
    hot = rng.integers(0, 3000, 600)
    made = [(i, float(h % 2), Vectors.sparse(3001, [0, int(h) + 1], [float(i % 9), 1.0])) for i, h in enumerate(hot)]
    df = spark.createDataFrame(made, ["booking_id", "label", "features"])
    seen = []
    monkeypatch.setattr(B, "tasks_for", lambda df, size, each: seen.append(size) or 1)
    model = B.Boosting(B.Settings(2, 3, 0.3, 1.0, 1.0)).fit(df)
    assert seen == [600 * 2]  # two bundles; 12 bundles of bytes before
    got = [r["probability"][1] for r in model.transform(df).orderBy("booking_id").collect()]
    x = np.zeros((600, 3001))
    x[:, 0], x[np.arange(600), hot + 1] = np.arange(600) % 9, 1
    assert np.allclose(got, 1 / (1 + np.exp(-model.margins(x))))
    assert packed(rows_in(x)).columns.shape == (3, 600)
    values = X.shap_values(model, df).select(X.additive().alias("ok")).collect()
    assert len(values) == 600 and all(r["ok"] for r in values)


def test_tests_on_packed_rows():
    """Cuts below 0, within 0 and 1 and beyond, on numbers, on one-hot slots and on slots that nothing fills."""
    x = np.array([[-2.5, 1, 0, 0, 0], [0.0, 0, 1, 0, 0], [3.0, 0, 0, 0, 0]])
    held = packed(rows_in(x))
    for slot in range(6):
        for cut in (-3.0, -0.5, 0.0, 0.5, 1.0, 2.0):
            column, a, b = held.tests(np.array([slot]), np.array([cut]))
            value = held.columns[column[0]]
            want = x[:, slot] <= cut if slot < 5 else np.zeros(3) <= cut
            assert np.array_equal(~((value > a[0]) & (value <= b[0])), want), (slot, cut)
