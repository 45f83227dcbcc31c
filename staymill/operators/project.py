"""Projections: principal components, supervised two-component PLS, and the tables behind 2-D maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.vectors import Rows, rows_of, slot_sums, unwrapped
from staymill.operators import encode as E
from staymill.plans.distributed import exact_quantiles

# --- PCA ----------------------------------------------------------------------


def scaled_vectors(df: DataFrame, column: str, scale: bool = True, out: str = "scaled") -> DataFrame:
    """Array or vector column, centred and (if asked) scaled."""
    if df.schema[column].dataType.typeName() == "array":
        df = df.withColumn("_v", array_to_vector(F.col(column).cast("array<double>")))
    else:
        df = df.withColumn("_v", F.col(column))
    return StandardScaler(inputCol="_v", outputCol=out, withMean=True, withStd=scale).fit(df).transform(df).drop("_v")


def fit_pca(scaled: DataFrame, k: int, column: str = "scaled", out: str = "pca") -> Model:
    return PCA(k=k, inputCol=column, outputCol=out).fit(scaled)


def explained(model: Model, spark: SparkSession) -> DataFrame:
    """(component, explained, cumulative); one row per component of the fitted model."""
    values = model.explainedVariance.toArray().tolist()
    total, rows = 0.0, []
    for i, v in enumerate(values):
        total += v
        rows.append((i + 1, v, total))
    return spark.createDataFrame(rows, "component int, explained double, cumulative double")


def components_for(explained_table: DataFrame, share: float = 0.95) -> DataFrame:
    return explained_table.where(F.col("cumulative") >= share).agg(F.min("component").alias("components"))


# --- PLS with one response ------------------------------------------------------


@dataclass(frozen=True)
class PLS:
    """Means, deviations and rotations (features x components); projection is (x - mean) / std . rotations."""

    mean: np.ndarray
    std: np.ndarray
    rotations: np.ndarray

    def flipped(self, axis: int) -> PLS:
        turned = self.rotations.copy()
        turned[:, axis] *= -1
        return replace(self, rotations=turned)


def fit_pls(df: DataFrame, vector: str, label: str, components: int = 2) -> PLS:
    """One distributed pass sums the moments of each slot, one more per component sums the rows along its direction.

    No square of the vector's length is formed: what reaches the driver is a few numbers per slot."""
    n, mean_y, sums_yy = df.agg(F.count(label), F.avg(label), F.sum(F.col(label).cast("double") * F.col(label))).first()
    if not n:
        raise ValueError("no rows to fit on")
    y = F.col(label).cast("double").alias("y")

    def moments(x: Rows, b: pa.RecordBatch) -> dict[str, np.ndarray]:
        return {"s": x.back(np.ones(len(x))), "ss": replace(x, value=x.value**2).back(np.ones(len(x))), "sy": x.back(np.asarray(b.column("y"), float))}

    got = slot_sums(df, vector, moments, ["s", "ss", "sy"], y)
    mean = got["s"] / n
    std = np.sqrt(np.maximum(got["ss"] - n * mean * mean, 0.0) / (n - 1))
    std_y = np.sqrt(max(sums_yy - n * mean_y * mean_y, 0.0) / (n - 1))
    std[std <= 1e-12] = 1.0
    toward = (got["sy"] - n * mean * mean_y) / (std * (std_y if std_y > 1e-12 else 1.0))

    def gram_times(w: np.ndarray) -> np.ndarray:
        """Product of the scaled columns' cross products with `w`."""
        u = w / std
        shift = mean @ u

        def along(x: Rows, b: pa.RecordBatch) -> dict[str, np.ndarray]:
            return {"xt": x.back(x.dot(u) - shift)}

        return slot_sums(df, vector, along, ["xt"])["xt"] / std  # the distances from `shift` add up to 0

    weights, loadings, sizes = [], [], []
    for _ in range(components):
        w = toward / (np.linalg.norm(toward) or 1.0)
        w = w * (np.sign(w[np.argmax(np.abs(w))]) or 1.0)
        along = gram_times(w) - sum((size * p * (p @ w) for size, p in zip(sizes, loadings)), np.zeros(len(w)))
        size = w @ along
        p, q = along / size, toward @ w / size
        toward = toward - size * q * p
        weights.append(w)
        loadings.append(p)
        sizes.append(size)
    w, p = np.array(weights).T, np.array(loadings).T
    return PLS(mean, std, w @ np.linalg.inv(p.T @ w))


def project(df: DataFrame, pls: PLS, vector: str, names: Sequence[str] = ("c1", "c2")) -> DataFrame:
    """Append one column per component: products of the filled slots, with the weights broadcast."""
    scaled = pls.rotations / pls.std[:, None]
    held = df.sparkSession.sparkContext.broadcast((scaled, pls.mean @ scaled))

    @F.arrow_udf("array<double>")
    def placed(column: pa.Array) -> pa.Array:
        weights, shift = held.value
        x = rows_of(column)
        flat = np.stack([x.dot(weights[:, i]) - shift[i] for i in range(len(shift))], axis=1).ravel()
        starts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(shift), mask=np.append(column.is_null().to_numpy(zero_copy_only=False), False))
        return pa.ListArray.from_arrays(starts, pa.array(flat))

    out = df.withColumn("_placed", placed(unwrapped(df, vector)))
    return out.withColumns({name: F.col("_placed")[i] for i, name in enumerate(names)}).drop("_placed")


def orient(df: DataFrame, pls: PLS, vector: str, label: str) -> tuple[PLS, bool]:
    """Turn axis 1 so that positives have the larger mean; returns whether it was turned."""
    means = project(df, pls, vector).agg(F.avg(F.when(F.col(label) == 1, F.col("c1"))).alias("pos"), F.avg(F.when(F.col(label) == 0, F.col("c1"))).alias("neg")).first()
    turn = means["pos"] < means["neg"]
    return (pls.flipped(0) if turn else pls), turn


# --- Tables behind the 2-D maps ----------------------------------------------------


def plane_limits(df: DataFrame, x: str = "c1", y: str = "c2") -> DataFrame:
    """(axis, low, high): 1st and 99th percentile per axis."""
    q = exact_quantiles(df, [x, y], [0.01, 0.99])
    return df.sparkSession.createDataFrame([(c, *q[c]) for c in (x, y)], "axis string, low double, high double")


def grid_points(limits: DataFrame, x: str = "c1", y: str = "c2", side: int = S.GRID_SIDE) -> DataFrame:
    """(gx, gy, x, y): a regular side x side grid over the limits, both ends included."""
    lim = {r["axis"]: (r["low"], r["high"]) for r in limits.collect()}
    cells = limits.sparkSession.range(side * side).select(F.floor(F.col("id") / side).cast("int").alias("gy"), (F.col("id") % side).cast("int").alias("gx"))

    def at(c: str, g: str) -> Column:
        low, high = lim[c]
        return F.lit(low) + F.col(g) * F.lit((high - low) / (side - 1))

    return cells.select("gx", "gy", at(x, "gx").alias(x), at(y, "gy").alias(y))


def plane_vector(df: DataFrame, columns: Sequence[str] = ("c1", "c2")) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=E.FEATURES_COL).transform(df)


def fit_on_plane(models: Mapping[str, Estimator], points: DataFrame) -> dict[str, Model]:
    """Refit each model on the two components of the training rows."""
    frame = plane_vector(points).persist()
    out = {name: m.fit(frame) for name, m in models.items()}
    frame.unpersist()
    return out


def decision_grid(models: Mapping[str, Model], grid: DataFrame) -> DataFrame:
    """(model, gx, gy, p) for every grid point and model."""
    frame = plane_vector(grid)
    out = None
    for name, model in models.items():
        one = model.transform(frame).select(F.lit(name).alias("model"), "gx", "gy", vector_to_array("probability")[1].cast("float").alias("p"))
        out = one if out is None else out.unionByName(one)
    return out


def scatter_sample(df: DataFrame, n: int = S.SCATTER_SAMPLE, seed: int = S.SEED, key: str = S.KEY, limits: DataFrame | None = None) -> DataFrame:
    """Fixed sample of points, optionally only inside the limits."""
    from staymill.operators.split import sample_n

    if limits is not None:
        for r in limits.collect():
            df = df.where(F.col(r["axis"]).between(r["low"], r["high"]))
    return sample_n(df, n, seed, key)


def surface_two_features(model: Model, df: DataFrame, x: str, y: str, side: int = 50, columns: Sequence[str] = tuple(S.FEATURES)) -> DataFrame:
    """(gx, gy, x, y, p): probability over two numeric raw columns, every other column held constant.

    Numbers are held at their median, categories at their most frequent value."""
    from staymill.operators.profile import describe_text

    numeric = [c for c in columns if c in S.NUMERIC]
    text = [c for c in columns if c not in numeric]
    medians = exact_quantiles(df, numeric, [0.5])
    modes = {r["variable"]: r["top"] for r in describe_text(df, text).collect()}
    span = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    limits = df.sparkSession.createDataFrame([(c, span[f"lo_{c}"], span[f"hi_{c}"]) for c in (x, y)], "axis string, low double, high double")
    grid = grid_points(limits, x, y, side)
    held = {c: F.lit(medians[c][0]) for c in numeric if c not in (x, y)} | {c: F.lit(modes.get(c)) for c in text}
    return model.transform(grid.withColumns(held)).select("gx", "gy", x, y, vector_to_array("probability")[1].alias("p"))


