"""Equi-join with a lookup table that holds up when a few keys have most of the rows.

Keys of the big side are counted first. A key with more than `slice_rows` rows is dealt out over as many salts as it has
slices, and its rows of the lookup table are replicated once per salt; all other keys join as usual. Rows without a key
match nothing, so a left join spreads them by their own hash. The table of heavy keys is broadcast: it has
`HEAVY_KEYS` rows at most, as the slices grow with the table beyond that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 200_000
HEAVY_KEYS = 100_000
NULL_SALTS = 1 << 20


def heavy_keys(big: DataFrame, keys: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(_h0, _h1, ..., _slices): the keys with more than one slice of rows."""
    counts = big.where(" and ".join(f"`{k}` is not null" for k in keys)).groupBy(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)])
    counts = counts.agg(F.count(F.lit(1)).alias("_n"))
    size = F.greatest(F.lit(slice_rows), F.ceil(F.lit(big.count() / HEAVY_KEYS)))
    return counts.where(F.col("_n") > size).select(*[f"_h{i}" for i in range(len(keys))], F.ceil(F.col("_n") / size).cast("int").alias("_slices"))


def lookup_join(
    big: DataFrame, table: DataFrame, keys: Sequence[str], spread: Sequence[str | Column], how: str = "inner", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """`big` joined to `table` on the columns `keys`, which both have; the result has each key once.

    `spread` are columns of `big` that tell rows of one key apart. They have to be the same when a task is run again,
    so no random number or row position will do."""
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    heavy = F.broadcast(heavy_keys(big, keys, slice_rows))

    def slices(df: DataFrame) -> DataFrame:
        same = None
        for i, k in enumerate(keys):
            one = F.col(k) == F.col(f"_h{i}")
            same = one if same is None else same & one
        return df.join(heavy, same, "left").drop(*[f"_h{i}" for i in range(len(keys))])

    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    salts = F.when(missing, F.lit(NULL_SALTS)).otherwise(F.coalesce("_slices", F.lit(1)))
    left = slices(big).withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_slices")
    right = slices(table).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))).drop("_slices")
    right = right.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)} | {"_salt": "_rsalt"})
    on = F.col("_salt") == F.col("_rsalt")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_r{i}"))
    return left.join(right, on, how).drop("_salt", "_rsalt", *[f"_r{i}" for i in range(len(keys))])
