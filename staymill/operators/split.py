"""Splits, folds, samples and class weights. All are functions of (key, seed), never of row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staymill.functions.hashing import mix
from staymill.functions.session import materialise
from staymill.plans.distributed import HASH_BITS, hash_rank
from staymill.schema import KEY, SEED, TARGET, TEST_SHARE

MAX_CLASSES = 1000  # a label with more values is not a class column
BROADCAST_CLASSES = 100_000


def head_n(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    return df.orderBy(key).limit(n)


def sample_n(df: DataFrame, n: int, seed: int = SEED, key: str = KEY) -> DataFrame:
    """Exactly min(n, rows) rows, without replacement: the n smallest in seeded hash order."""
    return df.orderBy(mix(key, seed), key).limit(n)


def _allocate(counts: dict, share: float) -> dict:
    """Test rows per class: the ceiling of the total, spread by largest remainder."""
    total = sum(counts.values())
    want = -(-round(total * share * 1e9) // 10**9)
    exact = {c: n * want / total for c, n in counts.items()} if total else {}
    got = {c: int(x) for c, x in exact.items()}
    rest = sorted(exact, key=lambda c: (got[c] - exact[c], str(c)))
    for c in rest[: want - sum(got.values())]:
        got[c] += 1
    return got


def hash_cuts(df: DataFrame, quotas, label: str | None, key: str, seed: int) -> dict:
    """Per class the (hash, key) of the last row inside its quota, found by two counting passes.

    `quotas` maps the class counts to the wanted rows per class. Pass one counts 65,536 hash buckets
    per class, which also gives the class counts; pass two resolves the one bucket that the cut falls
    into. Only rows that share a whole hash value are ever ordered by key."""
    u = df.select((F.col(label) if label else F.lit(0)).alias("c"), F.col(key).alias("k"), mix(key, seed).alias("u"))
    hist = u.groupBy("c", F.shiftright("u", HASH_BITS).alias("g")).agg(F.count(F.lit(1)).alias("n")).persist()
    counts = hist.groupBy("c").agg(F.sum("n").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label} has too many values to be a class column")
    wanted = {c: q for c, q in quotas({r["c"]: r["n"] for r in counts}).items() if q}
    kind = u.schema["c"].dataType.simpleString()
    coarse = _crossing(hist, wanted, kind)
    hist.unpersist()
    if not coarse:
        return {}
    spots = _by_class(df, [(c, b) for c, (b, _) in coarse.items()], f"_c {kind}, _b bigint")
    inside = u.join(spots, F.col("c").eqNullSafe(F.col("_c")) & (F.shiftright("u", HASH_BITS) == F.col("_b")), "left_semi")
    fine = inside.groupBy("c", F.col("u").alias("g")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"), F.max("k").alias("last"))
    cuts, ties = {}, []
    for c, (h, q, n, first, last) in _crossing(fine, {c: q for c, (_, q) in coarse.items()}, kind, "n", "first", "last").items():
        # Rows with one and the same 31-bit hash go in key order; one or two of them need no further look.
        if q == n or q == 1:
            cuts[c] = (h, last if q == n else first)
        else:
            ties.append((c, h, q))
    if ties:
        tied = u.join(_by_class(df, ties, f"_c {kind}, _h bigint, _q bigint"), F.col("c").eqNullSafe(F.col("_c")) & (F.col("u") == F.col("_h")))
        place = F.row_number().over(Window.partitionBy("c").orderBy("k"))
        for r in tied.withColumn("place", place).where("place = _q").select("c", "u", "k").collect():
            cuts[r["c"]] = (r["u"], r["k"])
    return cuts


def _by_class(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A table of one row per class, of which there are `MAX_CLASSES` at most."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _crossing(counts: DataFrame, quota: dict, kind: str, *extra: str) -> dict:
    """Per class the group `g` in which the running count reaches the quota, and what is left of it there."""
    want = _by_class(counts, [(c, int(q)) for c, q in quota.items()], f"_c {kind}, _want bigint")
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("g").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumn("upto", upto).join(want, F.col("c").eqNullSafe(F.col("_c")))
    hit = placed.where((F.col("_want") > F.col("upto") - F.col("n")) & (F.col("_want") <= F.col("upto")))
    rows = hit.select("c", "g", (F.col("_want") - F.col("upto") + F.col("n")).alias("left"), *extra).collect()
    return {r["c"]: (r["g"], int(r["left"]), *[r[x] for x in extra]) for r in rows}


def split_stratified(
    df: DataFrame, label: str = TARGET, share: float = TEST_SHARE, seed: int = SEED, key: str = KEY, out: str = "split"
) -> DataFrame:
    """Append `split` = train / test with exact per-class quotas.

    The fitted state is one cut per class, a table of `MAX_CLASSES` rows at most that is joined by broadcast, so rows are
    not shuffled and the plan does not grow with the classes."""
    kinds = {f.name: f.dataType.simpleString() for f in df.select(F.col(label).alias("c"), F.col(key).alias("k")).schema}
    cuts = hash_cuts(df, lambda counts: _allocate(counts, share), label, key, seed)
    table = _by_class(df, [(c, h, k) for c, (h, k) in cuts.items()], f"_c {kinds['c']}, _h bigint, _k {kinds['k']}")
    u = mix(key, seed)
    test = (u < F.col("_h")) | ((u == F.col("_h")) & (F.col(key) <= F.col("_k")))
    joined = df.join(table, F.col(label).eqNullSafe(F.col("_c")), "left")
    return joined.withColumn(out, F.when(test, "test").otherwise("train")).drop("_c", "_h", "_k")


def split_random(df: DataFrame, share: float = TEST_SHARE, seed: int = SEED, key: str = KEY, out: str = "split") -> DataFrame:
    """Independent draw per row: a hash threshold, no pass over the data."""
    return df.withColumn(out, F.when(mix(key, seed) < int(share * 2147483647), "test").otherwise("train"))


def fold_assign(
    df: DataFrame, k: int, label: str | None = TARGET, seed: int = SEED, key: str = KEY, out: str = "fold"
) -> DataFrame:
    """Fold number 0..k-1: rank in hash order (within the class, if given) modulo k."""
    ranked = hash_rank(df, key, seed, [label] if label else [], "_rank")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def split_class_ratio(df: DataFrame, label: str = TARGET, split: str = "split") -> DataFrame:
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col(split).alias("_s")).agg(F.sum("n").alias("_total"))
    return counts.join(totals, F.col(split) == F.col("_s")).select(split, label, "n", (F.col("n") / F.col("_total")).alias("share"))


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    mean_n = counts.agg(F.avg("n")).scalar()
    return counts.select(label, "n", (mean_n / F.col("n")).alias("weight"))


def pos_weight(df: DataFrame, label: str = TARGET) -> DataFrame:
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(neg.alias("negatives"), pos.alias("positives"), F.when(pos > 0, neg / pos).alias("scale_pos_weight"))


def add_weight(df: DataFrame, label: str = TARGET, kind: str = "balanced", out: str = "weight") -> DataFrame:
    """Weight column for training: balanced classes, or positives weighted by negatives / positives."""
    if kind == "balanced":
        weights = materialise(class_weights(df, label).select(F.col(label).alias("_class"), F.col("weight").alias("_weight")), "weights")
        if weights.count() <= BROADCAST_CLASSES:
            weights = F.broadcast(weights)
        joined = df.join(weights, F.col(label) == F.col("_class"), "left")
        return joined.withColumn(out, F.coalesce("_weight", F.lit(1.0))).drop("_class", "_weight")
    scale = pos_weight(df, label).first()["scale_pos_weight"]
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(scale if scale is not None else 1.0))).otherwise(F.lit(1.0)))


def _digest(df: DataFrame) -> Column:
    """256-bit digest of the whole row; null is told apart from every text."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)])), 256)


def dup_leak_share(test: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of test rows with an exact copy in train; null equals null.

    Both sides are reduced to one row per distinct digest first, so a text copied a billion
    times is one row in the join."""
    t = test.select(*columns)
    left = t.groupBy(_digest(t).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    s = train.select(*columns)
    right = s.select(_digest(s).alias("d")).distinct().withColumn("hit", F.lit(1))
    found = F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return left.join(right, "d", "left").agg(
        total.alias("test_rows"), found.alias("copied"), F.when(total > 0, found / total).alias("copied_share")
    )
