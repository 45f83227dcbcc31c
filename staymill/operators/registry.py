"""Model versions as a table (name, version, stage, ...). A promotion makes a new snapshot of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def register(runs: DataFrame, order: str, name: str = "name") -> DataFrame:
    """Number the runs of each name 1, 2, ... in the given order; new versions have no stage."""
    number = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return runs.withColumns({"version": number.cast("bigint"), "stage": F.lit("None")})


def latest(versions: DataFrame) -> DataFrame:
    return versions.groupBy("name").agg(F.max("version").alias("version"))


def promote(versions: DataFrame, chosen: DataFrame, stage: str) -> DataFrame:
    """Move the chosen (name, version) to the stage; whatever held that stage is archived.

    Names without a choice keep their stages."""
    pick = chosen.select(F.col("name").alias("_n"), F.col("version").alias("_v"))
    new = (
        F.when(F.col("version") == F.col("_v"), F.lit(stage))
        .when(F.col("_v").isNotNull() & (F.col("stage") == stage), F.lit("Archived"))
        .otherwise(F.col("stage"))
    )
    return versions.join(pick, F.col("name") == F.col("_n"), "left").withColumn("stage", new).drop("_n", "_v")


def lookup(versions: DataFrame, ref: str) -> DataFrame:
    """By number, or the newest version in a stage."""
    if ref.isdigit():
        return versions.where(F.col("version") == int(ref))
    newest = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("version")))
    return versions.where(F.col("stage") == ref).withColumn("_r", newest).where("_r = 1").drop("_r")
