"""Imputation, scaling and encoding, and the model matrix."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.session import materialise
from staymill.operators.features import FeatureBuilder, RareCategoryGrouper, RareCategoryModel
from staymill.plans.distributed import exact_quantiles
from staymill.plans.hotjoin import lookup_join


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "columns to work on", TypeConverters.toListString)


class _State(Params):
    state = Param(Params._dummy(), "state", "fitted values per column, JSON", TypeConverters.toString)

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault("state"))


class _ColumnEstimator(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=list(S.MODEL_NUMERIC))
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _present(self, df: DataFrame) -> list[str]:
        return [c for c in self.getOrDefault("columns") if c in df.columns]


class _ColumnModel(Model, _Columns, _State, DefaultParamsReadable, DefaultParamsWritable):
    @classmethod
    def of(cls, values: dict):
        return cls()._set(columns=list(values), state=json.dumps(values))


class FillModel(_ColumnModel):
    """Fill nulls of each column with its fitted value, as double."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double")) for c, v in self.values.items()})


class MedianImputer(_ColumnEstimator):
    """Exact medians of the fitted rows."""

    def _fit(self, df: DataFrame) -> FillModel:
        medians = exact_quantiles(df, self._present(df), [0.5])
        return FillModel.of({c: q[0] if q[0] is not None else 0.0 for c, q in medians.items()})


class MeanImputer(_ColumnEstimator):
    def _fit(self, df: DataFrame) -> FillModel:
        columns = self._present(df)
        row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        return FillModel.of({c: row[c] if row[c] is not None else 0.0 for c in columns})


class ConstantImputer(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls of text columns with one constant."""

    value = Param(Params._dummy(), "value", "fill text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=None, value=None):
        super().__init__()
        self._setDefault(columns=list(S.CATEGORICAL), value=S.UNKNOWN)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.na.fill(self.getOrDefault("value"), subset=[c for c in self.getOrDefault("columns") if c in df.columns])


class ScaleModel(_ColumnModel):
    """(x - shift) / scale per column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(a)) / F.lit(b) for c, (a, b) in self.values.items()})


class StandardScaler(_ColumnEstimator):
    """Mean 0 and population deviation 1; a constant column becomes 0."""

    def _fit(self, df: DataFrame) -> ScaleModel:
        columns = self._present(df)
        row = df.agg(*[f(c).alias(f"{n}{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return ScaleModel.of({c: (row[f"m{c}"] or 0.0, row[f"s{c}"] or 1.0) for c in columns})


class MinMaxScaler(_ColumnEstimator):
    """Range 0..1; a constant column becomes 0."""

    def _fit(self, df: DataFrame) -> ScaleModel:
        columns = self._present(df)
        row = df.agg(*[f(c).cast("double").alias(f"{n}{c}") for c in columns for n, f in (("a", F.min), ("z", F.max))]).first()
        return ScaleModel.of({c: (row[f"a{c}"] or 0.0, ((row[f"z{c}"] or 0.0) - (row[f"a{c}"] or 0.0)) or 1.0) for c in columns})


# --- Encoders as plain frames -------------------------------------------------


def onehot_long(df: DataFrame, train: DataFrame, columns: Sequence[str], key: str = S.KEY) -> DataFrame:
    """(key, feature, value=1) for every category that the fitted rows know; unseen ones give no row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in columns])
    long = df.select(key, F.inline(pairs)).where(F.col("level").isNotNull())
    known = train.select(F.inline(pairs)).where(F.col("level").isNotNull()).distinct()
    return lookup_join(long, known, ["variable", "level"], [key]).select(
        key, F.concat_ws("_", "variable", "level").alias("feature"), F.lit(1).alias("value")
    )


def levels(df: DataFrame, column: str, limit: int = 10_000) -> list[str]:
    """Sorted distinct values, for encoders that make one column per value."""
    rows = df.select(F.col(column).cast("string").alias("v")).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values; use onehot_long")
    return sorted(r["v"] for r in rows)


def _slug(value: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in value)


def dummies(df: DataFrame, column: str, train_levels: Sequence[str], drop_first: bool = False) -> DataFrame:
    """One 0/1 column per fitted level; unseen values give zeros everywhere. No shuffle."""
    chosen = list(train_levels)[1 if drop_first else 0:]
    return df.withColumns({f"{column}_{_slug(v)}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in chosen})


def ordinal_codes(df: DataFrame, column: str, train_levels: Sequence[str], out: str | None = None) -> DataFrame:
    """Position in the sorted levels; unseen or null gives null."""
    position = F.array_position(F.array(*map(F.lit, train_levels)), F.col(column))
    return df.withColumn(out or f"{column}_code", F.when(position > 0, (position - 1).cast("int")))


def poly_features(df: DataFrame, columns: Sequence[str], degree: int) -> DataFrame:
    """All monomials of total degree 1..degree, named by their factors: x, x^2, x*y."""
    from itertools import combinations_with_replacement

    new: dict[str, Column] = {}
    for d in range(2, degree + 1):
        for combo in combinations_with_replacement(columns, d):
            name = "__".join(f"{c}_{combo.count(c)}" if combo.count(c) > 1 else c for c in dict.fromkeys(combo))
            value = F.lit(1.0)
            for c in combo:
                value = value * F.col(c).cast("double")
            new[name] = value
    return df.withColumns(new)


# --- Model matrix -------------------------------------------------------------

FEATURES_COL = "features"


def preprocess_stages(numeric: Sequence[str] = tuple(S.MODEL_NUMERIC), categorical: Sequence[str] = tuple(S.CATEGORICAL), target: str = S.TARGET) -> list:
    """Derived features, category reduction, imputation, scaling, one-hot, one sparse vector."""
    numeric, categorical = list(numeric), list(categorical)
    idx = [f"_i_{c}" for c in categorical]
    hot = [f"_h_{c}" for c in categorical]
    return [
        FeatureBuilder(),
        RareCategoryGrouper(target=target),
        MedianImputer(columns=numeric),
        StandardScaler(columns=numeric),
        ConstantImputer(columns=categorical),
        StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"),
        # "keep" adds a last slot for unseen values; dropping it makes them an empty vector.
        OneHotEncoder(inputCols=idx, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=numeric + hot, outputCol=FEATURES_COL),
    ]


def fit_stages(stages: Sequence, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """The fitted stages, and the rows they were fitted on as the stages leave them.

    The rows are written once their categories are reduced: medians, deviations and levels take several passes, none of
    which has to join the kept categories again."""
    fitted = []
    for stage in stages:
        fitted.append(stage.fit(df) if isinstance(stage, Estimator) else stage)
        df = fitted[-1].transform(df)
        if isinstance(fitted[-1], RareCategoryModel):
            df = materialise(df, "reduced")
    return PipelineModel(stages=fitted), df


class Preprocessor(Pipeline):
    """The stages in one, fitted by `fit_stages`."""

    def _fit(self, df: DataFrame) -> PipelineModel:
        return fit_stages(self.getStages(), df)[0]


def preprocessor(**kw) -> Pipeline:
    return Preprocessor(stages=preprocess_stages(**kw))


def transform_features(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Apply a fitted preprocessor and keep only the named columns plus the vector."""
    return model.transform(df).select(*keep, FEATURES_COL)


def feature_names(df: DataFrame, column: str = FEATURES_COL) -> list[str]:
    """Names in vector order from the column's ML attributes, without the internal prefix."""
    attrs = df.schema[column].metadata["ml_attr"]["attrs"]
    flat = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [n[3:] if n.startswith("_h_") else n for _, n in flat]
