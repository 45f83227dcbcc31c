"""Clustering: k-means with elbow and silhouette, and density clusters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import materialise
from staymill.operators.neighbours import STAR_BLOCK, Cells, all_apart, all_near, build_cells, cell_join, one_cell, within
from staymill.plans.components import connected_components
from staymill.schema import SEED


def fit_kmeans(df: DataFrame, k: int, column: str, seed: int = SEED, max_iter: int = 50) -> Model:
    return KMeans(k=k, featuresCol=column, predictionCol="cluster", seed=seed, maxIter=max_iter, initMode="k-means||").fit(df)


def centroids(model: Model, df: DataFrame) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster int, centre array<double>")


def elbow(df: DataFrame, column: str, ks: Sequence[int] = tuple(range(1, 11)), seed: int = SEED) -> DataFrame:
    """(k, inertia); one cluster is the squared spread around the mean."""
    from pyspark.ml.stat import Summarizer

    rows = []
    for k in ks:
        if k == 1:
            s = df.select(Summarizer.metrics("count", "variance").summary(F.col(column)).alias("s")).first()["s"]
            rows.append((1, float(sum(s["variance"]) * (s["count"] - 1))))
        else:
            rows.append((k, float(fit_kmeans(df, k, column, seed).summary.trainingCost)))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def silhouette_fast(df: DataFrame, column: str, cluster: str = "cluster") -> float:
    """Mean silhouette on squared distances: one linear pass."""
    return ClusteringEvaluator(featuresCol=column, predictionCol=cluster, metricName="silhouette").evaluate(df)


def silhouette_exact(df: DataFrame, key: str, vector: str, clusters: Sequence[str], block_rows: int | None = None) -> DataFrame:
    """(key, labelling, cluster, silhouette) on Euclidean distances, for one or more label columns at once.

    Every distance counts here, so the work is quadratic by nature; blocks of rows meet blocks of rows,
    each distance is computed once for all labellings, and only a sum per row and cluster leaves a task.
    Use `silhouette_fast` where squared distances will do."""
    names = list(clusters)
    labels = [F.col(c).cast("bigint").alias(f"c{j}") for j, c in enumerate(names)]
    points = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"), *labels)
    points = materialise(points, "points")
    cells = one_cell(points, points.count())

    def members(d: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        coded = [pd.factorize(d[f"c{j}"]) for j in range(len(names))]
        which = np.repeat(np.arange(len(names)), [len(u) for _, u in coded])
        return np.hstack([np.eye(len(u))[codes] for codes, u in coded]), which, np.concatenate([u for _, u in coded])

    def rows(q: pd.DataFrame, total: np.ndarray, which: np.ndarray, other: np.ndarray) -> pd.DataFrame:
        own = np.stack([q[f"c{j}"].to_numpy() for j in range(len(names))], axis=1)
        return pd.DataFrame({
            "k": np.repeat(q["k"].to_numpy(), len(which)), "j": np.tile(which, len(q)), "c": own[:, which].ravel(),
            "other": np.tile(other, len(q)), "s": total.ravel(),
        })

    def sums(q: pd.DataFrame, qv: np.ndarray, d: pd.DataFrame, dv: np.ndarray, both: bool) -> pd.DataFrame:
        there, *ids = members(d)
        here, *own = members(q) if both else (None, None, None)
        to_d, to_q = [], 0.0
        for part, m in all_apart(qv, dv):
            to_d.append(m @ there)
            if both:
                to_q = to_q + m.T @ here[part]
        out = rows(q, np.vstack(to_d), *ids)
        return pd.concat([out, rows(d, to_q, *own)], ignore_index=True) if both else out

    parts = cell_join(points, cells, sums, f"k {dict(points.dtypes)['k']}, j int, c bigint, other bigint, s double", radius=np.inf, block_rows=block_rows, same=True)
    pairs = F.array(*[F.struct(F.lit(j).alias("_j"), F.col(f"c{j}").alias("_o")) for j in range(len(names))])
    size = points.select(F.inline(pairs)).groupBy("_j", "_o").agg(F.count(F.lit(1)).alias("n"))
    total = parts.groupBy("k", "j", "c", "other").agg(F.sum("s").alias("s")).join(size, (F.col("other") == F.col("_o")) & (F.col("j") == F.col("_j")))
    own = F.col("c") == F.col("other")
    row = total.groupBy("k", "j", "c").agg(
        F.max(F.when(own, F.col("n"))).alias("n"),
        F.max(F.when(own & (F.col("n") > 1), F.col("s") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"),
    )
    value = F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0)))
    return row.select(F.col("k").alias(key), F.array(*map(F.lit, names))[F.col("j")].alias("labelling"), F.col("c").alias("cluster"), value.alias("silhouette"))


# --- Density clusters -------------------------------------------------------------


def _weighed(hit: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Per row of `hit` the sum of the weights it hits; weights of 1, as most are, need no product."""
    out = np.count_nonzero(hit, axis=1).astype("int64")
    more = np.flatnonzero(w != 1)
    return out + hit[:, more] @ (w[more] - 1) if len(more) else out


def _counts(points: DataFrame, cells: Cells, eps: float, block_rows: int) -> DataFrame:
    def count(q: pd.DataFrame, qv: np.ndarray, d: pd.DataFrame, dv: np.ndarray, both: bool) -> pd.DataFrame:
        here, there = q["w"].to_numpy(dtype="int64"), d["w"].to_numpy(dtype="int64")
        n, back = [], np.zeros(len(d), "int64")
        for part, hit in all_near(qv, dv, eps):
            n.append(_weighed(hit, there))
            if both:
                back += _weighed(hit.T, here[part])
        out = pd.DataFrame({"k": q["k"], "n": np.concatenate(n)})
        return pd.concat([out, pd.DataFrame({"k": d["k"], "n": back})], ignore_index=True) if both else out

    found = within(points.select("k", "v", "w"), cells, eps, count, f"k {dict(points.dtypes)['k']}, n bigint", block_rows, same=True)
    return found.groupBy("k").agg(F.sum("n").alias("n"))


def _distinct_points(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """All rows (k, v) and one weighted row per distinct vector: copies never meet each other."""
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    return rows, materialise(rows.groupBy("v").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("w")).select("k", "v", "w"), "points")


def dbscan_core(df: DataFrame, key: str, vector: str, eps: float, min_samples: int, block_rows: int | None = None) -> DataFrame:
    """(key, neighbours, core): rows within eps (the row itself included) and whether they are enough."""
    rows, points = _distinct_points(df, key, vector)
    n = _counts(points, build_cells(points), eps, block_rows)
    spread = points.select(F.col("v").alias("_v"), "k").join(n, "k").drop("k")
    return rows.join(spread, F.col("v") == F.col("_v")).select(F.col("k").alias(key), F.col("n").alias("neighbours"), (F.col("n") >= min_samples).alias("core"))


def _lowest(near: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Per row of `near`, which hits something, the smallest label it hits."""
    order = labels.argsort(kind="stable")
    step = max(1, (1 << 24) // len(order))
    return labels[order][np.concatenate([near[i : i + step][:, order].argmax(axis=1) for i in range(0, len(near), step)])]


def dbscan(df: DataFrame, key: str, vector: str, eps: float, min_samples: int, block_rows: int | None = None) -> DataFrame:
    """(key, label, core): the label is the smallest core key of the cluster, -1 for noise.

    A border row joins the cluster with the smallest label among its core neighbours. A task reduces the
    links inside its pair of blocks to a spanning star per group, so dense regions do not emit all pairs."""
    rows, points = _distinct_points(df, key, vector)
    kind = dict(points.dtypes)["k"]
    counted = points.join(_counts(points, build_cells(points), eps, block_rows), "k")
    state = materialise(counted.withColumn("core", F.col("n") >= min_samples).select("k", "v", "core"), "state")
    core = state.where("core").select("k", "v")
    if core.isEmpty():
        return rows.select(F.col("k").alias(key), F.lit(-1).cast(kind).alias("label"), F.lit(False).alias("core"))

    def stars(q: pd.DataFrame, qv: np.ndarray, d: pd.DataFrame, dv: np.ndarray, both: bool) -> pd.DataFrame:
        near = np.vstack([m for _, m in all_near(qv, dv, eps)])
        # Links run both ways, so a pair of blocks that comes up once has them all. Rows without a link are left out.
        hq, hd = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        near = near[np.ix_(hq, hd)]
        qk, dk = q["k"].to_numpy()[hq], d["k"].to_numpy()[hd]
        if not len(qk):
            return pd.DataFrame({"a": qk, "b": qk})
        back = np.ascontiguousarray(near.T)
        ql, dl = qk.copy(), dk.copy()
        while True:  # smallest key within each group of linked rows of the two blocks
            nd = np.minimum(dl, _lowest(back, ql))
            nq = np.minimum(ql, _lowest(near, nd))
            if (nd == dl).all() and (nq == ql).all():
                break
            ql, dl = nq, nd
        a, b = np.concatenate([qk, dk]), np.concatenate([ql, dl])
        return pd.DataFrame({"a": a, "b": b})[a != b]

    cells = build_cells(core)
    edges = within(core, cells, eps, stars, f"a {kind}, b {kind}", block_rows, STAR_BLOCK, same=True)
    labelled = core.join(connected_components(edges).withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("label", "k"))
    labelled = materialise(labelled.select("k", "v", "label"), "labelled")

    def lowest(q: pd.DataFrame, qv: np.ndarray, d: pd.DataFrame, dv: np.ndarray, both: bool) -> pd.DataFrame:
        order = d["label"].to_numpy().argsort(kind="stable")
        labels, out, hit = d["label"].to_numpy()[order], [], []
        for _, near in all_near(qv, dv[order], eps):
            out.append(labels[near.argmax(axis=1)])
            hit.append(near.any(axis=1))
        return pd.DataFrame({"k": q["k"].to_numpy(), "label": np.concatenate(out)})[np.concatenate(hit)]

    loose = state.where("NOT core").select("k", "v")
    border = within(loose, build_cells(labelled), eps, lowest, f"k {kind}, label {kind}", block_rows).groupBy("k").agg(F.min("label").alias("label"))
    points_labelled = labelled.select("k", "label", F.lit(True).alias("core")).unionByName(border.select("k", "label", F.lit(False).alias("core")))
    full = state.select("k", F.col("v").alias("_v")).join(points_labelled, "k", "left").drop("k")
    return rows.join(full, F.col("v") == F.col("_v")).select(
        F.col("k").alias(key), F.coalesce("label", F.lit(-1).cast(kind)).alias("label"), F.coalesce("core", F.lit(False)).alias("core"))


