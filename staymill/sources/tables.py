"""Reading the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Row key per table whose rows carry much work each.
_KEYS = {"orders": "o_orderkey", "documents": "doc_id", "embeddings": "vec_id"}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core when a plain scan has fewer splits than the cluster has cores.

    A big table has more splits than cores and is left as it is, so no shuffle is added there."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, _KEYS[name]) if name in _KEYS else df
