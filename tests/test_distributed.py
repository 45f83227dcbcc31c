import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from staymill.operators import metrics as M
from staymill.plans import distributed as D
from staymill.plans.components import connected_components


@pytest.fixture(scope="module")
def hot(spark):
    """Values of which a third are one and the same."""
    rng = np.random.default_rng(3)
    v = np.where(rng.random(3000) < 0.34, 7.0, np.round(rng.normal(5, 20, 3000), 2))
    pdf = pd.DataFrame({"k": range(3000), "v": v, "g": rng.integers(0, 3, 3000)})
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("limit", [10**6, 200, 20])
def test_quantiles(hot, limit):
    df, pdf = hot
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    got = D.exact_quantiles(df, ["v"], probs, exact_rows=limit)["v"]
    assert np.allclose(got, np.percentile(pdf["v"], [100 * p for p in probs]))


def test_quantiles_of_nothing(spark):
    assert D.exact_quantiles(spark.createDataFrame([], "v double"), ["v"], [0.5]) == {"v": [None]}


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(hot, descending):
    df, pdf = hot
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = D.running_sums(counts, "v", ["n"], ["g"], descending, buckets=7).toPandas().sort_values(["g", "v"], ascending=[True, not descending])
    want = pdf.groupby(["g", "v"]).size().rename("n").reset_index().sort_values(["g", "v"], ascending=[True, not descending])
    assert (got["cum_n"].to_numpy() == want.groupby("g")["n"].cumsum().to_numpy()).all()


def test_hash_rank(hot):
    df, pdf = hot
    got = D.hash_rank(df, "k", 5, ["g"]).toPandas()
    for g, part in got.groupby("g"):
        assert sorted(part["rank"]) == list(range(1, (pdf["g"] == g).sum() + 1))


def test_qq_points_unroll_a_hot_value(hot):
    from statistics import NormalDist

    df, pdf = hot
    got = M.qq_points(df.withColumnRenamed("v", "residual"), "k").toPandas().sort_values("position")
    assert (got["position"].to_numpy() == np.arange(1, 3001)).all()
    assert np.allclose(got["value"], np.sort(pdf["v"]))
    assert np.allclose(got["theoretical"], [NormalDist().inv_cdf(p) for p in got["prob"]], atol=1e-9)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    edges += [(1000, 1001 + i) for i in range(50)]  # a hub
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent}
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r["node"]: r["label"] for r in got.collect()} == want


def _scores(spark, y, p):
    return spark.createDataFrame([(a, float(b), int(b >= 0.5)) for a, b in zip(y, p)], "y int, p double, pred int")


def test_perfect_and_inverted(spark):
    df = _scores(spark, [0, 1, 0, 1], [0.1, 0.9, 0.2, 0.8])
    assert M.binary_metrics(df).first().asDict() == {"accuracy": 1.0, "precision": 1.0, "recall": 1.0, "f1": 1.0}
    assert M.roc_auc(df).first()["roc_auc"] == 1.0
    assert M.roc_auc(_scores(spark, [0, 1], [0.9, 0.1])).first()["roc_auc"] == 0.0


def test_metric_edges(spark):
    none = _scores(spark, [0, 0], [0.1, 0.1])
    assert M.binary_metrics(none).first().asDict() == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    assert M.roc_auc(none).first()["roc_auc"] is None
    assert M.roc_auc(_scores(spark, [0, 1, 1], [0.5, 0.5, 0.5])).first()["roc_auc"] == 0.5
    assert [r["n"] for r in M.confusion_matrix(none).collect()] == [2, 0, 0, 0]


def test_select_best_keeps_first_on_tie(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.5)], "model string, roc_auc double")
    assert M.select_best(df, ["b", "a", "c"]).first()["model"] == "b"


def test_corr_matrix_without_numbers(spark):
    from staymill.operators.profile import corr_matrix

    nan = float("nan")
    df = spark.createDataFrame([(nan, None, 1.0), (2.0, None, 2.0), (3.0, None, 4.0), (4.0, None, 5.0)], "a double, b double, c double")
    r = {(x.a, x.b): x.r for x in corr_matrix(df, ["a", "b", "c"]).collect()}
    assert r["a", "b"] is None and r["b", "b"] is None and r["a", "c"] == pytest.approx(0.9819805)


def test_roc_curve_of_one_class(spark):
    from staymill.operators.metrics import roc_curve

    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, p double")
    assert [(x.fpr, x.tpr) for x in roc_curve(df).orderBy("tpr").collect()] == [(0.0, 0.0), (None, 0.5), (None, 1.0)]


def test_many_classes(spark):
    from staymill.operators.split import add_weight

    df = spark.range(3000).selectExpr("id", "cast(id % 1500 as int) as label")
    assert add_weight(df, "label").where("weight = 1.0").count() == 3000
