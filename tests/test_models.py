from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staymill.catalog.base import bookings
from staymill.operators import explain as X
from staymill.operators import models as M
from staymill.operators import score as SC
from staymill.plans import jobs as JB
from staymill.sources import store as ST
from staymill.streaming import score as ST_SCORE


@pytest.fixture(scope="module")
def ready(spark, small):
    train, test = JB.load_and_prepare(bookings(spark, small))
    pre, (tr, te) = M.prepare(train, test)
    return train, test, pre, tr, te


def _brute(trees, x):
    """Shapley values from all subsets of the features: known ones follow the row, unknown ones average by cover."""
    out = np.zeros(len(x))
    used = sorted({int(f) for t in trees for f, l in zip(t["feature"], t["left"]) if l >= 0})

    def expect(t, n, known):
        if t["left"][n] < 0:
            return t["value"][n]
        a, b = t["left"][n], t["right"][n]
        if t["feature"][n] in known:
            return expect(t, a if x[t["feature"][n]] <= t["threshold"][n] else b, known)
        return (t["cover"][a] * expect(t, a, known) + t["cover"][b] * expect(t, b, known)) / t["cover"][n]

    def value(known):
        return sum(expect(t, 0, known) for t in trees)

    for j in used:
        rest = [f for f in used if f != j]
        for size in range(len(rest) + 1):
            w = factorial(size) * factorial(len(rest) - size) / factorial(len(rest) + 1)
            out[j] += w * sum(value({*s, j}) - value(set(s)) for s in combinations(rest, size))
    return out


def test_shap_equals_all_subsets(ready, spark):
    tr = ready[3]
    x = np.stack([r["x"] for r in tr.select(vector_to_array("features").alias("x")).limit(5).collect()])
    for model in (M.tree(max_depth=3, min_leaf=20).fit(tr), M.boosting(2, 3).fit(tr)):
        flat = X.tree_arrays(model, spark)
        phi, base, _ = X.shap_matrix(x, flat)
        for row, got in zip(x, phi):
            assert np.allclose(got, _brute(flat.trees, row))


def test_shap_of_features_tested_again():
    """A deep tree over few features: each is tested several times on a path."""
    rng = np.random.default_rng(4)
    n, depth = 2**7 - 1, 6
    inner = np.arange(2**depth - 1)
    left = np.where(np.arange(n) < len(inner), 2 * np.arange(n) + 1, -1)
    cover = np.zeros(n)
    cover[2**depth - 1:] = rng.integers(1, 9, 2**depth)
    for i in inner[::-1]:
        cover[i] = cover[2 * i + 1] + cover[2 * i + 2]
    tree = {"feature": rng.integers(0, 4, n), "threshold": rng.random(n), "left": left, "right": np.where(left >= 0, left + 1, -1), "value": rng.normal(size=n), "cover": cover}
    x = rng.random((7, 4))
    phi, base, margin = X.shap_matrix(x, X.Trees([tree], 0.5))
    for row, got in zip(x, phi):
        assert np.allclose(got, _brute([tree], row))
    assert np.allclose(base + phi.sum(axis=1), margin)


@pytest.mark.parametrize("kind", ["tree", "forest", "boosting"])
def test_shap_adds_up(ready, kind):
    tr, te = ready[3], ready[4]
    model = {"tree": M.tree(6, 10), "forest": M.forest(5, 5, 5), "boosting": M.boosting(5, 3)}[kind].fit(tr)
    got = X.shap_values(model, te).toPandas().set_index("booking_id")
    p = model.transform(te).select("booking_id", vector_to_array("probability")[1].alias("p")).toPandas().set_index("booking_id")["p"]
    total = got["base"] + got["shap"].map(sum)
    if kind == "boosting":
        total = 1 / (1 + np.exp(-total))
    assert np.allclose(total, p.loc[got.index])


def test_models_beat_chance(ready):
    tr, te = ready[3], ready[4]
    fitted, seconds = M.fit_all({"tree": M.tree(5, 20), "logistic": M.logistic(tr.count())}, tr)
    out = {r["model"]: r["roc_auc"] for r in M.evaluate(fitted, te).collect()}
    assert min(out.values()) > 0.6 and set(seconds) == set(out)


def test_permutation_keeps_rows_and_finds_the_signal(ready, spark):
    train, test, pre, tr, _ = ready
    model = M.full_pipeline(pre, M.tree(5, 20).fit(tr))
    shuffled = X.permute_column(test, "lead_time")
    assert sorted(r["lead_time"] for r in shuffled.collect()) == sorted(r["lead_time"] for r in test.collect())
    moved = shuffled.select("booking_id", F.col("lead_time").alias("n")).join(test.select("booking_id", "lead_time"), "booking_id").where("n != lead_time").count()
    assert moved > test.count() / 2
    got = {r["feature"]: r["importance_mean"] for r in X.permutation_importance(model, test, ["deposit_type", "lead_time", "babies", *[c for c in test.columns if c not in ("booking_id", "is_canceled", "deposit_type", "lead_time", "babies")]], repeats=2).collect()}
    assert max(got, key=got.get) in ("deposit_type", "lead_time") and abs(got["babies"]) < 0.02


def test_linear_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=300)
    df = M.assemble(spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double"), ["a", "b", "c"], "y")
    full = np.linalg.lstsq(np.c_[np.ones(300), x], y, rcond=None)[0]
    m = M.linear(df)
    assert np.allclose([m.intercept, *m.coefficients], full, atol=1e-6)
    xc, yc = x - x.mean(0), y - y.mean()
    b = np.zeros(3)  # lasso on the mean by coordinate descent
    for _ in range(500):
        for j in range(3):
            r = yc - xc @ b + xc[:, j] * b[j]
            g = xc[:, j] @ r / 300
            b[j] = np.sign(g) * max(abs(g) - 0.3, 0) / (xc[:, j] @ xc[:, j] / 300)
    assert np.allclose(M.linear(df, lasso=0.3).coefficients, b, atol=1e-4)
    assert np.allclose(M.linear(df, ridge=10.0).coefficients, np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc), atol=1e-5)


@pytest.mark.parametrize("C", [0.01, 1.0])
def test_logistic_regularisation(spark, C):
    """Newton steps on half the squared weights plus C times the summed loss."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2)) * [1.0, 3.0]
    y = (x[:, 0] + rng.normal(size=200) > 0.3).astype(float)
    a, w = np.c_[x, np.ones(200)], np.zeros(3)
    keep = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w = w - np.linalg.solve(keep + C * (a.T * (p * (1 - p))) @ a, keep @ w + C * a.T @ (p - y))
    df = M.assemble(spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, y double"), ["a", "b"], "y")
    m = M.logistic(200, C).setTol(1e-10).fit(df)
    assert np.allclose([*m.coefficients, m.intercept], w, atol=1e-4)


def test_job_stream_and_batch_agree(ready, spark, small, tmp_path):
    raw = bookings(spark, small)
    job = JB.train_job(raw, str(tmp_path / "job"), names=["Decision Tree"])
    assert job["best"] == "Decision Tree" and ST.best_metric(job["metrics"]).first()["value"] > 0.55
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "job/metrics_md")).collect()]
    assert lines[0].startswith("| Modelo | accuracy")
    model = ST.load_model(str(tmp_path / "job/models"), "best")
    whole = raw.na.fill("Desconocido", ["country", "agent"]).na.fill("no_company", ["company"]).na.fill(0.0, ["children"])
    batch = {r["booking_id"]: r["probability_canceled"] for r in SC.score_batch(model, whole).collect()}
    assert len(batch) == raw.count()
    from staymill import schema as S

    whole.select("booking_id", *S.FEATURES).write.json(str(tmp_path / "in"))
    q = ST_SCORE.score_stream(ST_SCORE.booking_stream(spark, str(tmp_path / "in")), model, str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "mark"))
    q.awaitTermination()
    streamed = {r["booking_id"]: r["probability_canceled"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == batch and spark.read.parquet(str(tmp_path / "bad")).count() == 0
    assert SC.score_batch(model, whole.limit(0)).count() == 0
    with pytest.raises(FileNotFoundError):
        ST.load_model(str(tmp_path / "job/models"), "nothing")


def test_stores(spark, tmp_path):
    df = spark.createDataFrame([("a", 3), ("b", 4)], "model string, depth int")
    ST.params_table(df, "model").write.parquet(str(tmp_path / "p"))
    assert {r["model"]: r["depth"] for r in ST.read_params(spark, str(tmp_path / "p"), "depth int").collect()} == {"a": 3, "b": 4}
    assert ST.read_params(spark, str(tmp_path / "none"), "depth int").count() == 0
    assert ST.slug("Neural Network (small)") == "neural_network_small"


def test_threshold_before_rounding(spark):
    df = spark.createDataFrame([(0.49996,), (0.5,), (0.12345,)], "p double")
    got = [(r[0], r[1]) for r in df.select(*SC.decide(F.col("p")).values()).collect()]
    assert got == [(0, 0.5), (1, 0.5), (0, 0.1234)]


def test_registered_queries_have_full_sizes(spark, small, monkeypatch):
    """Five models, whole searches and all repeats, caught before they are fitted."""
    from staymill.catalog import QUERIES, modelling as C

    seen = {}
    monkeypatch.setattr(C.M, "fit_all", lambda models, df: (None, seen.setdefault("models", models) and dict.fromkeys(models, 1.0)))
    monkeypatch.setattr(C.TU, "tune", lambda train, names, *grids: (seen.update(tune=(names, grids)) or {n: {} for n in names}, [(n, "Grid", 1, 0.5, 1.0) for n in names]))
    monkeypatch.setattr(C.X, "permutation_importance", lambda model, df, **kw: seen.update(permutation=kw))
    monkeypatch.setattr(C.JB, "train_job", lambda df, out, *cut: seen.update(job=cut) or {"metrics": None})
    monkeypatch.setattr(C.JB, "map_job", lambda train, test, *cut: seen.update(map=cut) or {"grid": None})
    assert C.train_times(spark, small).count() == 5
    assert (seen["models"]["Random Forest"].getNumTrees(), seen["models"]["Random Forest"].getMaxDepth()) == (200, 18)
    assert (seen["models"]["Gradient Boosting"].getMaxIter(), seen["models"]["Gradient Boosting"].getMaxDepth()) == (500, 14)
    C.tuning_report(spark, small)
    C.decision_grid(spark, small)
    for name in ("permutation_importance", "train_job"):
        with pytest.raises(AttributeError):  # what was caught gives no table
            QUERIES[name](spark, small)
    assert seen["tune"] == (list(C.S.GRIDS), ()) and seen["permutation"] == {} and seen["job"] == () and seen["map"] == ()
