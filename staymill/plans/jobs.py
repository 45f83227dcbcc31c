"""Whole jobs: train, score, build the 2-D map. Each step leaves a table, so a job can be inspected and resumed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.session import materialise
from staymill.operators import encode as E
from staymill.operators import models as M
from staymill.operators import plane as PL
from staymill.operators import project as PR
from staymill.operators import tune as TU
from staymill.operators.clean import clean
from staymill.operators.metrics import comparison_table
from staymill.operators.score import score_batch
from staymill.operators.split import sample_n, split_stratified
from staymill.sources import store as ST
from staymill.sources.csv import load_raw


def load_and_prepare(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean and split; the cleaned rows are written once, the split is a condition on them."""
    split = split_stratified(materialise(clean(df), "cleaned"))
    return split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")


def train_job(df: DataFrame, out: str, overrides: Mapping[str, Mapping] | None = None, names: Sequence[str] | None = None, searched: str | None = None) -> dict:
    """Train the catalogue on raw bookings, compare on the test rows, keep everything under `out`.

    `overrides` holds parameters per model, `searched` the folder in which a search kept its best ones; what is absent in
    both keeps its default."""
    spark = df.sparkSession
    if searched:
        overrides = {**TU.best_params(spark, searched), **(overrides or {})}
    train, test = load_and_prepare(df)
    pre, (tr, te) = M.prepare(train, test)
    models = M.catalogue(tr.count(), M.width_of(tr), overrides)
    models = {n: m for n, m in models.items() if names is None or n in names}
    fitted, seconds = M.fit_all(models, tr)
    times = spark.createDataFrame(list(seconds.items()), "_m string, train_time_s double")
    metrics = M.evaluate(fitted, te).join(times, F.col("model") == F.col("_m")).drop("_m")
    table = comparison_table(metrics, list(models))
    ST.write_metrics(table.coalesce(1), f"{out}/metrics")
    stored = ST.read_metrics(spark, f"{out}/metrics")
    ST.write_markdown(stored, f"{out}/metrics_md")
    paths = ST.save_models({n: M.full_pipeline(pre, m) for n, m in fitted.items()}, f"{out}/models")
    best = comparison_table(stored, list(models)).first()["model"]
    ST.save_models({"best": M.full_pipeline(pre, fitted[best])}, f"{out}/models")
    return {"metrics": stored, "best": best, "models": paths, "pre": pre, "fitted": fitted, "train": tr, "test": te}


def score_job(spark: SparkSession, model: PipelineModel, out: str, csv: str | None = None, base: DataFrame | None = None, sample: int = 10, key: str = S.KEY) -> DataFrame:
    """Score a CSV, or a sample of the base rows, into a CSV of predictions with their keys."""
    df = load_raw(spark, csv) if csv else sample_n(base, sample, key=key)
    ST.write_predictions(score_batch(model, df, (key,)), out, key)
    return spark.read.option("header", True).schema(f"{key} bigint, prediction int, probability_canceled double").csv(out)


def map_job(train: DataFrame, test: DataFrame, overrides: Mapping[str, Mapping] | None = None, side: int = S.GRID_SIDE, out: str | None = None) -> dict:
    """The 2-D map: PLS plane of the prepared rows, models refitted on it, scored grid, fixed scatter points.

    With `out` the map is saved there; `StoredMap` reads it again."""
    pre, (tr, te) = M.prepare(train, test)
    plane = PL.PlaneProjector(labelCol=M.LABEL).fit(tr)
    points = materialise(plane.transform(tr).select(S.KEY, M.LABEL, "c1", "c2"), "plane")
    limits = plane.limits_table(train.sparkSession)
    params = {"Neural Network": {"hidden": [64, 32], "max_iter": 400}, **(overrides or {})}
    models = PR.fit_on_plane(M.catalogue(points.count(), 2, params), points)
    grid = PR.decision_grid(models, PR.grid_points(limits, side=side))
    scatter = PR.scatter_sample(plane.transform(te).select(S.KEY, M.LABEL, "c1", "c2"))
    if out:
        PL.save_map(out, pre, plane, models, grid)
        grid = PL.StoredMap(train.sparkSession, out).grid()
    turned = plane.getOrDefault("turned")
    return {"pre": pre, "plane": plane, "pls": plane.pls, "turned": turned, "limits": limits, "models": models, "grid": grid, "scatter": scatter, "points": points}


def project_bookings(pre: PipelineModel, pls: PR.PLS, df: DataFrame, key: str = S.KEY) -> DataFrame:
    """Place raw bookings on a fitted plane."""
    return PR.project(pre.transform(df).select(key, E.FEATURES_COL), pls, E.FEATURES_COL).select(key, "c1", "c2")
