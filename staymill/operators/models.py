"""The model catalogue, training and evaluation. Every model reads the same prepared vector."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.session import materialise
from staymill.operators import encode as E
from staymill.operators.boosting import Boosting, Settings
from staymill.operators.cells import CellForest, CellRegressor
from staymill.operators.forest import Forest
from staymill.operators.metrics import evaluate_models
from staymill.operators.network import Network
from staymill.operators.network import Settings as NetworkSettings
from staymill.operators.tree import Tree

LABEL = "label"
_IO = {"featuresCol": E.FEATURES_COL, "labelCol": LABEL}
# Bytes a tree worker may use per level; more means fewer passes over the data.
_TREE = {"maxMemoryInMB": 512, "maxBins": 64, "seed": S.SEED}


def _depth(d: int | None) -> int:
    return S.SPARK_MAX_DEPTH if d is None else min(d, S.SPARK_MAX_DEPTH)


def logistic(n: int, C: float = 1.0, max_iter: int = 1000, weight: str | None = None, **_) -> Estimator:
    """Inverse regularisation C over n rows: the mean loss carries 1 / (C n)."""
    m = LogisticRegression(**_IO, maxIter=max_iter, regParam=1.0 / (C * n), standardization=False)
    return m.setWeightCol(weight) if weight else m


def tree(max_depth: int | None = 12, min_leaf: int = 50, criterion: str = "gini", weight: str | None = None, **_) -> Estimator:
    m = DecisionTreeClassifier(**_IO, **_TREE, maxDepth=_depth(max_depth), minInstancesPerNode=min_leaf, impurity=criterion)
    return Tree(m.setWeightCol(weight) if weight else m)


def forest(trees: int = 200, max_depth: int | None = 18, min_leaf: int = 20, max_features: str = "sqrt", weight: str | None = None, **_) -> Estimator:
    return Forest(trees, _depth(max_depth), min_leaf, max_features, E.FEATURES_COL, LABEL, weight)


def boosting(
    trees: int = 500, max_depth: int | None = 14, rate: float = 0.1, subsample: float = 0.9, colsample: float = 0.9,
    weight: str | None = None, validation: str | None = None, tolerance: float = 1e-4, patience: int = 10, tasks: int | None = None, **_,
) -> Estimator:
    """Second-order boosting. With a `validation` column, growing stops when the held-out loss has not fallen by `tolerance`
    for `patience` trees, and the trees up to the best one are kept."""
    settings = Settings(trees, _depth(max_depth), rate, subsample, colsample, patience=patience if validation else 0, tolerance=tolerance)
    return Boosting(settings, E.FEATURES_COL, LABEL, weight, validation, tasks=tasks)


def network(width: int, hidden: tuple[int, ...] = (64, 32, 16), max_iter: int = 60, dropout: float = 0.3, patience: int = 10, tasks: int | None = None, **_) -> Estimator:
    """Dense ReLU layers with dropout after the first; a fifth of the rows decides when to stop. `width` follows from the rows."""
    return Network(NetworkSettings(tuple(hidden), max_iter, dropout=dropout, patience=patience), E.FEATURES_COL, LABEL, tasks=tasks)


def linear_svm(reg: float = 0.01, max_iter: int = 100) -> Estimator:
    return LinearSVC(**_IO, regParam=reg, maxIter=max_iter)


def catalogue(n: int, width: int, overrides: Mapping[str, Mapping] | None = None) -> dict[str, Estimator]:
    """The five models with their parameters, each overridable by name."""
    p = {name: {**base, **(overrides or {}).get(name, {})} for name, base in S.MODEL_PARAMS.items()}
    return {
        "Logistic Regression": logistic(n, **p["Logistic Regression"]),
        "Decision Tree": tree(**p["Decision Tree"]),
        "Random Forest": forest(**p["Random Forest"]),
        "Gradient Boosting": boosting(**p["Gradient Boosting"]),
        "Neural Network": network(width, **p["Neural Network"]),
    }


def prepare(train: DataFrame, *others: DataFrame, keep: tuple[str, ...] = (S.KEY,), target: str = S.TARGET) -> tuple[PipelineModel, list[DataFrame]]:
    """Fit the shared preprocessing on train once; write each prepared frame once for all models."""
    pre, done = E.fit_stages(E.preprocess_stages(target=target), train)
    label = F.col(target).cast("double").alias(LABEL)
    out = []
    for rows in (done, *map(pre.transform, others)):
        extra = [c for c in keep if c in rows.columns]
        out.append(materialise(rows.select(*extra, label, E.FEATURES_COL), "prepared"))
    return pre, out


def width_of(df: DataFrame) -> int:
    return df.select(E.FEATURES_COL).first()[0].size


def fit_all(models: Mapping[str, Estimator], prepared: DataFrame) -> tuple[dict[str, Model], dict[str, float]]:
    """Fitted models and wall seconds each."""
    fitted, seconds = {}, {}
    for name, estimator in models.items():
        start = time.perf_counter()
        fitted[name] = estimator.fit(prepared)
        seconds[name] = time.perf_counter() - start
    return fitted, seconds


def full_pipeline(pre: PipelineModel, model: Model) -> PipelineModel:
    """One artefact that scores raw bookings."""
    return PipelineModel(stages=[*pre.stages, model])


def score_frame(models: Mapping[str, Model], prepared: DataFrame, key: str = S.KEY) -> DataFrame:
    """Long frame (model, key, y, p, pred) over all models."""
    out = None
    for name, model in models.items():
        p = vector_to_array("probability")[1]
        one = model.transform(prepared).select(
            F.lit(name).alias("model"), key, F.col(LABEL).cast("int").alias("y"), p.alias("p"), (p >= S.THRESHOLD).cast("int").alias("pred")
        )
        out = one if out is None else out.unionByName(one)
    return out


def evaluate(models: Mapping[str, Model], prepared: DataFrame, key: str = S.KEY) -> DataFrame:
    """Five metrics per model; the scores are written once, since ranking reads them several times."""
    return evaluate_models(materialise(score_frame(models, prepared, key), "scores"))


def feature_importance(model: Model, names: list[str], df: DataFrame, top: int = 20) -> DataFrame:
    pairs = sorted(zip(names, model.featureImportances.toArray().tolist()), key=lambda t: (-t[1], t[0]))[:top]
    return df.sparkSession.createDataFrame([(i + 1, n, float(v)) for i, (n, v) in enumerate(pairs)], "rank int, feature string, importance double")


def learning_curve(model: Model, train: DataFrame, valid: DataFrame) -> DataFrame:
    """(iteration, split, loss) of a boosted model after every tree."""
    curves = {"train": model.evaluateEachIteration(train), "valid": model.evaluateEachIteration(valid)}
    rows = [(i + 1, split, float(v)) for split, c in curves.items() for i, v in enumerate(c)]
    return train.sparkSession.createDataFrame(rows, "iteration int, split string, loss double")


# --- Regression -----------------------------------------------------------------


def linear(df: DataFrame, ridge: float = 0.0, lasso: float = 0.0, max_iter: int = 200) -> Model:
    """Least squares; ridge as penalty on the summed squares, lasso on the mean.

    Spark fits on a label of unit deviation and divides the penalty by that deviation once, which is
    right for lasso; a ridge penalty in the label's own units therefore carries the deviation."""
    reg, mix = lasso, 1.0
    if not lasso:
        reg, mix = 0.0, 0.0
        if ridge:
            n, spread = df.agg(F.count(LABEL), F.stddev_pop(LABEL)).first()
            reg = ridge * (spread or 1.0) / n
    solver = "auto" if lasso else "normal"
    return LinearRegression(**_IO, regParam=reg, elasticNetParam=mix, standardization=False, solver=solver, maxIter=max_iter, tol=1e-9).fit(df)


def formula(model: Model, names: list[str], target: str = "y", digits: int = 4) -> str:
    terms = "".join(f" {'+' if c >= 0 else '-'} {abs(c):.{digits}f} * {n}" for n, c in zip(names, model.coefficients))
    return f"{target} = {model.intercept:.{digits}f}{terms}"


def tree_regressor(**kw) -> Estimator:
    return DecisionTreeRegressor(**_IO, **_TREE, **kw)


def forest_regressor(maxDepth: int = 5, numTrees: int = 20) -> Estimator:
    return CellForest(numTrees, maxDepth, E.FEATURES_COL, LABEL)


def boosting_regressor(**kw) -> Estimator:
    return CellRegressor(GBTRegressor(**_IO, **_TREE, **kw), E.FEATURES_COL, LABEL)


def assemble(df: DataFrame, columns: list[str], label: str, *keep: str) -> DataFrame:
    """Plain numeric matrix for the regression models."""
    from pyspark.ml.feature import VectorAssembler

    vec = VectorAssembler(inputCols=columns, outputCol=E.FEATURES_COL)
    return vec.transform(df.withColumn(LABEL, F.col(label).cast("double"))).select(*keep, LABEL, E.FEATURES_COL)
