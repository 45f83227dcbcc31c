"""Whole-table orderings without a whole-table task.

Quantiles, ranks and running sums over a big frame need a global order. A window without a
partition would put every row in one task; here the order is cut into buckets first (by hash
or by sampled boundaries), totals per bucket give the offsets, and the exact order is only
resolved inside a bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staymill.functions.hashing import mix

HASH_BITS = 15  # low bits of the 31-bit order hash; the upper 16 are the bucket


def _bounds(df: DataFrame, col: str, buckets: int) -> list[float]:
    probs = [i / buckets for i in range(1, buckets)]
    got = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, 10_000).alias("q")).first()["q"]
    return sorted(set(got or []))


def bucket_by_value(df: DataFrame, col: str, buckets: int | None = None, out: str = "_b") -> DataFrame:
    """Ordered bucket number of a numeric column, boundaries from one sketch pass."""
    buckets = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    splits = [float("-inf"), *_bounds(df, col, buckets), float("inf")]
    splits = sorted(set(splits))
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)


def running_sums(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Inclusive running sums of `sums` in the order of the distinct double column `order` per group.

    `df` must hold one row per (by, order), so that no order value can dominate a bucket."""
    df = bucket_by_value(df, order, buckets)
    groups = [*by, "_b"]
    totals = df.groupBy(*groups).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # One row per group and bucket: small, so this window is small too.
    rank = F.col("_b").desc() if descending else F.col("_b").asc()
    before = Window.partitionBy(*by).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums])
    inner = Window.partitionBy(*groups).orderBy(F.col(order).desc() if descending else F.col(order).asc())
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumns({f"_l_{c}": F.sum(c).over(inner) for c in sums})
    return (
        _with_offsets(local, offsets, groups)
        .withColumns({f"{prefix}{c}": F.col(f"_l_{c}") + F.col(f"_o_{c}") for c in sums})
        .select(*[c for c in df.columns if c != "_b"], *[f"{prefix}{c}" for c in sums])
    )


def hash_rank(df: DataFrame, key: str, seed: int, by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Dense 1-based rank of the rows in seeded hash order, within `by`.

    65,536 hash buckets give the offsets; a window only ever sees one bucket of one group."""
    df = df.withColumn("_u", mix(key, seed)).withColumn("_b", F.shiftright("_u", HASH_BITS).cast("int"))
    groups = [*by, "_b"]
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inner = Window.partitionBy(*groups).orderBy("_u", key)
    ranked = _with_offsets(df.withColumn("_r", F.row_number().over(inner)), offsets, groups)
    return ranked.withColumn(out, (F.col("_r") + F.col("_o")).cast("bigint")).drop("_u", "_b", "_r", "_o")


def _with_offsets(df: DataFrame, offsets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Attach the per-bucket offsets; null group values match each other."""
    renamed = offsets.withColumnsRenamed({g: f"_g_{g}" for g in groups})
    cond = None
    for g in groups:
        same = F.col(g).eqNullSafe(F.col(f"_g_{g}"))
        cond = same if cond is None else cond & same
    return df.join(renamed, cond).drop(*[f"_g_{g}" for g in groups])


_SIGN_FREE = (1 << 63) - 1


def _images(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, v, s): number of the column, value, and a signed 64-bit image of the double that has the order of the values.

    Non-negative doubles order like their bits; of negative ones all bits but the sign are turned. NaN is the largest."""
    pairs = [F.struct(F.lit(i).alias("c"), (F.col(c).cast("double") + F.lit(0.0)).alias("v")) for i, c in enumerate(cols)]
    long = df.select(F.inline(F.array(*pairs))).where(F.col("v").isNotNull())
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.col("v")).cast("bigint")
    raw = long.select("c", "v", bits.alias("b"))
    return raw.select("c", "v", F.when(F.col("b") < 0, F.col("b").bitwiseXOR(F.lit(_SIGN_FREE))).otherwise(F.col("b")).alias("s"))


def _wanted(df: DataFrame, open_: dict[tuple[int, int], list[int]]) -> DataFrame:
    """One row per bucket that holds wanted places: its column, its prefix, the places counted from its first row."""
    rows = [F.struct(F.lit(c).alias("_c"), F.lit(p).cast("bigint").alias("_p"), F.array(*[F.lit(q).cast("bigint") for q in sorted(set(at))]).alias("at"))
            for (c, p), at in open_.items()]
    return F.broadcast(df.sparkSession.range(1).select(F.inline(F.array(*rows))))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], exact_rows: int | None = None) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles, exact at any size, by radix selection.

    Rows are counted by the first 16 bits of an order-preserving image of their values, for all columns together; the
    rows of the buckets that hold a wanted place are counted by the next 16 bits, and so on: at most four passes, of
    which only counts are shuffled (65,536 at most per column and wanted bucket). A bucket of one distinct value ends
    its search, so whole numbers and hot values take one or two passes. `exact_rows` has no effect any more."""
    cols, probs = list(dict.fromkeys(cols)), list(probs)
    if not cols or not probs:
        return {c: [None] * len(probs) for c in cols}
    totals = list(df.agg(*[F.count(F.col(c).cast("double")) for c in cols]).first())
    places = {(i, j): p * (n - 1) for i, n in enumerate(totals) if n for j, p in enumerate(probs)}
    found: dict[tuple[int, int], float] = {}
    # Bucket -> wanted places inside it, and what has to be added for the place in the whole column.
    open_, start = {}, {}
    for (i, _), at in places.items():
        open_.setdefault((i, 0), []).extend([int(at // 1), int(-(-at // 1))])
        start[i, 0] = 0
    images = _images(df, cols)
    for shift in (48, 32, 16, 0):
        if not open_:
            break
        wanted = _wanted(df, open_)
        prefix = F.shiftright("s", shift + 16) if shift < 48 else F.lit(0).cast("bigint")
        rows = images.select("c", "v", "s", prefix.alias("p"))
        rows = rows.join(wanted, (F.col("c") == F.col("_c")) & (F.col("p") == F.col("_p")), "left_semi")
        counts = rows.groupBy("c", "p", F.shiftright("s", shift).alias("g")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        upto = F.sum("n").over(Window.partitionBy("c", "p").orderBy("g").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        placed = counts.withColumn("before", upto - F.col("n")).join(wanted, (F.col("c") == F.col("_c")) & (F.col("p") == F.col("_p")))
        here = F.filter("at", lambda q: (q >= F.col("before")) & (q < F.col("before") + F.col("n")))
        hits = placed.withColumn("here", here).where(F.size("here") > 0).select("c", "p", "g", "before", "low", "high", "here").collect()
        open_, last, start = {}, start, {}
        for h in hits:
            first = last[h["c"], h["p"]]
            if shift == 0 or h["low"] == h["high"]:
                found.update({(h["c"], first + q): h["low"] for q in h["here"]})
            else:
                open_[h["c"], h["g"]] = [q - h["before"] for q in h["here"]]
                start[h["c"], h["g"]] = first + h["before"]
    result = {c: [None] * len(probs) for c in cols}
    for (i, j), at in places.items():
        low, high = int(at // 1), int(-(-at // 1))
        a, b = found[i, low], found[i, high]
        result[cols[i]][j] = a if low == high or a == b else (high - at) * a + (at - low) * b
    return result
