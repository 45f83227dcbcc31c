import numpy as np
import pandas as pd
import pytest

from staymill.operators import cluster as K
from staymill.operators import neighbours as N
from staymill.operators import project as PR


@pytest.fixture(scope="module")
def cloud(spark):
    """Blobs, scattered rows, and a third of all rows in one place."""
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.3, (60, 3)) for c in (0, 3, 6)] + [rng.uniform(-4, 10, (30, 3)), np.tile([[3.0, 3.0, 3.0]], (110, 1))])
    pdf = pd.DataFrame({"k": np.arange(len(x)), "v": x.tolist(), "y": np.arange(len(x)) % 4})
    return spark.createDataFrame(pdf), x


def _dist(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))


@pytest.mark.parametrize("block_rows", [2000, 25])
def test_nearest(cloud, block_rows):
    df, x = cloud
    got = N.nearest(df, df, 5, "k", "v", "y", exclude_self=True, block_rows=block_rows).toPandas().sort_values(["query", "position"])
    d = _dist(x)
    np.fill_diagonal(d, np.inf)
    want = np.lexsort((np.tile(np.arange(len(x)), (len(x), 1)), d), axis=1)[:, :5]
    assert (got["neighbour"].to_numpy().reshape(-1, 5) == want).all()
    assert (got["y"].to_numpy() == got["neighbour"].to_numpy() % 4).all()


@pytest.mark.parametrize("block_rows", [2000, 25])
def test_dbscan(cloud, block_rows):
    df, x = cloud
    eps, least = 0.5, 6
    near = _dist(x) <= eps
    core = near.sum(axis=1) >= least
    label = np.where(core, np.arange(len(x)), 10**6)
    while True:
        new = np.where(core, np.where(near & core[None], label[None], 10**6).min(axis=1), label)
        if (new == label).all():
            break
        label = new
    border = np.where(near & core[None], label[None], 10**6).min(axis=1)
    want = np.where(core, label, np.where(border < 10**6, border, -1))
    got = K.dbscan(df, "k", "v", eps, least, block_rows).toPandas().sort_values("k")
    assert (got["label"].to_numpy() == want).all() and (got["core"].to_numpy() == core).all()
    counts = K.dbscan_core(df, "k", "v", eps, least, block_rows).toPandas().sort_values("k")
    assert (counts["neighbours"].to_numpy() == near.sum(axis=1)).all()


def test_dbscan_without_core(cloud):
    df, _ = cloud
    assert {r["label"] for r in K.dbscan(df, "k", "v", 0.5, 10_000).collect()} == {-1}


@pytest.mark.parametrize("block_rows", [2000, 40])
def test_silhouette(cloud, block_rows):
    df, x = cloud
    d, y = _dist(x), np.arange(len(x)) % 4
    means = np.stack([d[:, y == c].sum(axis=1) for c in range(4)], axis=1)
    n = np.bincount(y)
    a = means[np.arange(len(x)), y] / (n[y] - 1)
    other = means / n
    other[np.arange(len(x)), y] = np.inf
    b = other.min(axis=1)
    got = K.silhouette_exact(df, "k", "v", ["y"], block_rows).toPandas().sort_values("k")
    assert np.allclose(got["silhouette"], (b - a) / np.maximum(a, b))


def test_smote(spark, cloud):
    from pyspark.sql import functions as F

    df, x = cloud
    df = df.select("k", "v", F.when(F.col("k") < 70, 1).otherwise(0).alias("y"))
    made = N.smote(df, "v", "y", "k").toPandas()
    assert len(made) == len(x) - 140 and made["synthetic"].is_unique
    per_base = made.groupby("base").size()
    assert len(per_base) == 70 and per_base.max() - per_base.min() <= 1
    d = _dist(x[:70])
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :5]
    for r in made.itertuples():
        assert r.neighbour in near[r.base]
        assert np.allclose(r.v, x[r.base] + r.u * (x[r.neighbour] - x[r.base]))


def test_pls_equals_row_wise_nipals(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 6)) @ rng.normal(size=(6, 6)) + 4
    y = (x[:, 0] + rng.normal(size=200) > 4).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"v": x.tolist(), "y": y}))
    pls = PR.fit_pls(df, "v", "y")
    e, f = (x - x.mean(0)) / x.std(0, ddof=1), (y - y.mean()) / y.std(ddof=1)
    for i, c in enumerate(("c1", "c2")):
        w = e.T @ f / np.linalg.norm(e.T @ f)
        w *= np.sign(w[np.abs(w).argmax()])
        t = e @ w
        p = e.T @ t / (t @ t)
        e, f = e - np.outer(t, p), f - t * (f @ t) / (t @ t)
        assert np.allclose(PR.project(df, pls, "v").toPandas()[c], t)
    turned, flag = PR.orient(df, pls.flipped(0), "v", "y")
    means = PR.project(df, turned, "v").groupBy("y").avg("c1").toPandas().set_index("y")["avg(c1)"]
    assert means[1.0] > means[0.0]


def test_pca_sums_to_one(spark, cloud):
    df, _ = cloud
    table = PR.explained(PR.fit_pca(PR.scaled_vectors(df, "v"), 3), spark).toPandas()
    assert np.isclose(table["cumulative"].iloc[-1], 1.0) and table["explained"].is_monotonic_decreasing


def test_pls_of_more_slots_than_a_square_may_have(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    hot, x = rng.integers(0, 5000, 400), rng.normal(size=400)
    y = (x + (hot % 3) + rng.normal(size=400) > 1).astype(float)
    rows = [(float(a), Vectors.sparse(5000, [int(h)], [1.0]), float(b)) for a, h, b in zip(x, hot, y)]
    df = VectorAssembler(inputCols=["a", "hot"], outputCol="v").transform(spark.createDataFrame(rows, ["a", "hot", "y"]))
    full = np.zeros((400, 5001))
    full[:, 0], full[np.arange(400), hot + 1] = x, 1.0
    std = full.std(0, ddof=1)
    std[std <= 1e-12] = 1.0
    e, f = (full - full.mean(0)) / std, (y - y.mean()) / y.std(ddof=1)
    got = PR.project(df, PR.fit_pls(df, "v", "y"), "v").toPandas()
    for c in ("c1", "c2"):
        w = e.T @ f / np.linalg.norm(e.T @ f)
        w *= np.sign(w[np.abs(w).argmax()])
        t = e @ w
        p = e.T @ t / (t @ t)
        e, f = e - np.outer(t, p), f - t * (f @ t) / (t @ t)
        assert np.allclose(got[c], t)


def test_project_keeps_rows_without_a_vector(spark):
    pls = PR.PLS(np.zeros(2), np.ones(2), np.eye(2))
    got = PR.project(spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "k int, v array<double>"), pls, "v").orderBy("k").collect()
    assert (got[0]["c1"], got[0]["c2"]) == (1.0, 2.0) and got[1]["c1"] is None


def test_blocks_agree_with_differences_and_are_faster():
    """Far from the origin, copies, rows at the radius exactly, missing numbers: as the plain differences say."""
    import time

    rng = np.random.default_rng(4)
    a = rng.normal(size=(700, 16)) + 1e7
    b = np.vstack([a[:200], a[:150] + np.eye(16)[0], rng.normal(size=(300, 16)) + 1e7])
    d = np.vstack([m for _, m in N.distances(a, b)])
    assert np.allclose(np.vstack([m for _, m in N.all_apart(a, b)]), d, rtol=1e-8, atol=0)
    for radius in (0.0, 1.0, float(d[3, 400]), float(d.max())):
        assert (np.vstack([m for _, m in N.all_near(a, b, radius)]) == (d <= radius)).all()
    odd = a.copy()
    odd[5, 2], odd[6, 0] = np.nan, np.inf
    with np.errstate(invalid="ignore"):
        want = np.vstack([m for _, m in N.distances(odd, b)]) <= 6.0
        assert (np.vstack([m for _, m in N.all_near(odd, b, 6.0)]) == want).all()

    def seconds(run):
        begun = time.perf_counter()
        for _ in run():
            pass
        return time.perf_counter() - begun

    x = rng.normal(size=(2000, 64))
    assert min(seconds(lambda: N.all_apart(x, x)) for _ in range(3)) * 4 < seconds(lambda: N.distances(x, x))


def test_blocks_are_few_where_cells_rule_out_nothing(spark, monkeypatch):
    """Rows in all directions: every row meets the same number of blocks at any size, and a pair of blocks comes up once."""
    met = []
    run = type(spark.range(1)).groupBy

    def watched(self, *by):
        if by == ("cell", "ds", "qs"):
            met.append(self.select("k", *by).toPandas())
        return run(self, *by)

    monkeypatch.setattr(type(spark.range(1)), "groupBy", watched)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 40))
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(len(x)), "v": x.tolist()}))
    got = K.dbscan_core(df, "k", "v", 8.0, 5, block_rows=100).toPandas().sort_values("k")
    assert (got["neighbours"].to_numpy() == (_dist(x) <= 8.0).sum(axis=1)).all()
    left, right = met
    assert len(left) + len(right) == len(x) * 13  # 12 blocks; a pair of different ones once
