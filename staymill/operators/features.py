"""Derived features and supervised category reduction as Spark ML stages."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.absence import id_key, is_absent
from staymill.functions.session import SMALL_STATE_ROWS, scratch_path
from staymill.plans.hotjoin import lookup_join

INLINE_KEEP = 1000  # a longer keep list is joined instead of written into the expression


def nights() -> Column:
    return F.coalesce(F.col("stays_in_week_nights"), F.lit(0)) + F.coalesce(F.col("stays_in_weekend_nights"), F.lit(0))


def presence(df: DataFrame, col: str) -> Column:
    """1 if the column holds a real value, 0 if it is absent or the column is not there."""
    if col not in df.columns:
        return F.lit(0)
    return F.when(is_absent(F.col(col), df.schema[col].dataType), 0).otherwise(1)


class FeatureBuilder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless row-wise step: children filled, nights, presence flags, clean identifier keys."""

    def _transform(self, df: DataFrame) -> DataFrame:
        new: dict[str, Column] = {}
        if "children" in df.columns:
            new["children"] = F.coalesce(F.col("children"), F.lit(0)).cast("int")
        if {"stays_in_week_nights", "stays_in_weekend_nights"} <= set(df.columns):
            new["noches"] = nights()
        new["has_company"] = presence(df, "company")
        new["has_agent"] = presence(df, "agent")
        for c in S.RARE_COLUMNS:
            if c in df.columns:
                new[c] = id_key(F.col(c), df.schema[c].dataType)
        return df.withColumns(new)


def rare_stats(
    df: DataFrame, columns: Sequence[str], target: str = S.TARGET,
    min_n: int = S.RARE_MIN_N, hi: float = S.RARE_HI, lo: float = S.RARE_LO,
) -> DataFrame:
    """(variable, value, rate, n, keep) per non-null category.

    Kept: enough rows and a rate above hi * top or below lo * top, where top is the highest rate
    among the categories with enough rows. All columns share one grouping; the top rate per
    column is one more (tiny) grouping, so no column has to fit into one task."""
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
    stats = (
        df.select(F.col(target).alias("y"), F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.avg("y").alias("rate"), F.count(F.lit(1)).alias("n"))
    )
    top = stats.where(F.col("n") >= min_n).groupBy(F.col("variable").alias("_v")).agg(F.max("rate").alias("_top"))
    keep = (F.col("n") >= min_n) & ((F.col("rate") > hi * F.col("_top")) | (F.col("rate") < lo * F.col("_top")))
    return stats.join(top, F.col("variable") == F.col("_v"), "left").select(
        "variable", "value", "rate", "n", F.coalesce(keep, F.lit(False)).alias("keep")
    )


def seen_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every (variable, value) that occurs: the keep table of an unsupervised fit."""
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()


def rare_apply(df: DataFrame, keep: DataFrame, columns: Sequence[str], null_labels: dict[str, str]) -> DataFrame:
    """Reduction by joining the keep table (variable, value); used when it is too long to inline.

    Frequent values are split over tasks, and so are rows without a value."""
    names, spread = df.columns, df.columns
    for c in columns:
        kept = keep.where(F.col("variable") == c).select(F.col("value").alias("_value"), F.lit(True).alias("_kept"))
        df = lookup_join(df.withColumn("_value", F.col(c).cast("string")), kept, ["_value"], spread, "left")
        label = F.lit(null_labels.get(c, S.RARE_NULL_LABELS["agent"]))
        df = df.withColumn(c, F.when(F.col(c).isNull(), label).when(F.col("_kept"), F.col("_value")).otherwise(S.RARE_OTHER)).select(names)
    return df


def rare_leak_diff(train: DataFrame, full: DataFrame, columns: Sequence[str] = tuple(S.RARE_COLUMNS)) -> DataFrame:
    """Per column: categories kept on train and on all rows, and how many appear or vanish between them."""
    a = rare_stats(train, columns).where("keep").select("variable", "value", F.lit(1).alias("t"))
    b = rare_stats(full, columns).where("keep").select("variable", "value", F.lit(1).alias("f"))
    both = a.join(b, ["variable", "value"], "full")
    return both.groupBy("variable").agg(
        F.count("t").alias("kept_train"), F.count("f").alias("kept_full"),
        F.count_if(F.col("t").isNull()).alias("only_full"), F.count_if(F.col("f").isNull()).alias("only_train"),
    )


class _RareParams(Params):
    columns = Param(Params._dummy(), "columns", "columns to reduce", TypeConverters.toListString)
    target = Param(Params._dummy(), "target", "target column; empty keeps every seen value", TypeConverters.toString)
    minN = Param(Params._dummy(), "minN", "rows a category needs", TypeConverters.toInt)
    hi = Param(Params._dummy(), "hi", "share of the top rate above which a category is kept", TypeConverters.toFloat)
    lo = Param(Params._dummy(), "lo", "share of the top rate below which a category is kept", TypeConverters.toFloat)
    nullLabels = Param(Params._dummy(), "nullLabels", "label of null per column, JSON", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(
            columns=list(S.RARE_COLUMNS), target=S.TARGET, minN=S.RARE_MIN_N, hi=S.RARE_HI, lo=S.RARE_LO,
            nullLabels=json.dumps(S.RARE_NULL_LABELS),
        )


class RareCategoryGrouper(Estimator, _RareParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which categories to keep; all others become one label."""

    @keyword_only
    def __init__(self, *, columns=None, target=None, minN=None, hi=None, lo=None, nullLabels=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> RareCategoryModel:
        columns = [c for c in self.getOrDefault("columns") if c in df.columns]
        if self.getOrDefault("target"):
            keep = rare_stats(
                df, columns, self.getOrDefault("target"), self.getOrDefault("minN"), self.getOrDefault("hi"), self.getOrDefault("lo")
            ).where("keep").select("variable", "value")
        else:
            keep = seen_values(df, columns)
        model = RareCategoryModel()
        model._set(columns=columns, nullLabels=self.getOrDefault("nullLabels"))
        rows = keep.limit(SMALL_STATE_ROWS + 1).collect()
        if len(rows) <= SMALL_STATE_ROWS:
            lists = {c: sorted(r["value"] for r in rows if r["variable"] == c) for c in columns}
            return model._set(keep=json.dumps(lists))
        path = scratch_path(df.sparkSession, "keep")
        keep.write.parquet(path)
        return model._set(keepPath=path)


class _KeepWriter(DefaultParamsWriter):
    """Writes a long keep table beside the parameters, so that the saved model stands alone."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        table = self.instance.getOrDefault("keepPath")
        if table:
            self.sparkSession.read.parquet(table).write.parquet(f"{path}/keep")


class _KeepReader(DefaultParamsReader):
    def load(self, path: str) -> RareCategoryModel:
        model = super().load(path)
        return model._set(keepPath=f"{path}/keep") if model.getOrDefault("keepPath") else model


class RareCategoryModel(Model, _RareParams, DefaultParamsReadable, DefaultParamsWritable):
    keep = Param(Params._dummy(), "keep", "kept values per column, JSON", TypeConverters.toString)
    keepPath = Param(Params._dummy(), "keepPath", "parquet table of kept values, if they are many", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._defaults()
        self._setDefault(keep="{}", keepPath="")

    def write(self) -> MLWriter:
        return _KeepWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _KeepReader(cls)

    @property
    def kept(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault("keep"))

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = [c for c in self.getOrDefault("columns") if c in df.columns]
        labels = json.loads(self.getOrDefault("nullLabels"))
        spark = df.sparkSession
        if self.getOrDefault("keepPath"):
            return rare_apply(df, spark.read.parquet(self.getOrDefault("keepPath")), columns, labels)
        kept = self.kept
        long = [c for c in columns if len(kept.get(c, [])) > INLINE_KEEP]
        for c in columns:
            if c in long:
                continue
            values = kept.get(c, [])
            inside = F.col(c).cast("string").isin(values) if values else F.lit(False)
            label = F.lit(labels.get(c, S.RARE_NULL_LABELS["agent"]))
            df = df.withColumn(c, F.when(F.col(c).isNull(), label).when(inside, F.col(c).cast("string")).otherwise(S.RARE_OTHER))
        if long:
            table = spark.createDataFrame([(c, v) for c in long for v in kept[c]], "variable string, value string")
            df = rare_apply(df, table, long, labels)
        return df


def build_features(df: DataFrame) -> DataFrame:
    return FeatureBuilder().transform(df)


__all__ = [
    "FeatureBuilder", "RareCategoryGrouper", "RareCategoryModel", "build_features",
    "nights", "presence", "rare_apply", "rare_leak_diff", "rare_stats", "seen_values",
]
