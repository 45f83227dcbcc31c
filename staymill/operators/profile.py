"""Profiling aggregates for exploration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymill import schema as S
from staymill.plans.distributed import exact_quantiles
from staymill.plans.gram import pair_sums


def rate_by(df: DataFrame, column: str, target: str = S.TARGET) -> DataFrame:
    """Mean target and non-null target rows per value, highest rate first; the null value is left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.avg(target).alias("rate"), F.count(target).alias("n"))
        .orderBy(F.desc("rate"), "value")
    )


def rates_by(df: DataFrame, columns: Sequence[str], target: str = S.TARGET) -> DataFrame:
    """`rate_by` for several columns from one pass over the rows."""
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.col(target).alias("y"), F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
        .groupBy("variable", "value").agg(F.avg("y").alias("rate"), F.count("y").alias("n"))
        .orderBy("variable", F.desc("rate"), "value")
    )


def class_balance(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    label = F.coalesce(F.try_element_at(F.array(*map(F.lit, S.CLASS_LABELS)), F.col(target).cast("int") + 1), F.col(target).cast("string"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.orderBy(target).select(
        label.alias("label"), "n", F.bround(F.col("n") / total * 100, 2).alias("percent")
    )


def _long(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast(cast).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def numeric_summary(df: DataFrame, columns: Sequence[str] = tuple(S.SUMMARY_COLUMNS), digits: int = 2) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max per column; one row per column."""
    columns = [c for c in columns if c in df.columns]
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    stats = _long(df, columns, "double").groupBy("variable").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    def pick(i: int) -> Column:
        c = F.lit(None).cast("double")
        for name in columns:
            c = F.when(F.col("variable") == name, F.lit(q[name][i]).cast("double")).otherwise(c)
        return c
    r = lambda c: F.bround(c, digits)
    return stats.select(
        "variable", "count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"), r(F.col("min")).alias("min"),
        r(pick(0)).alias("p25"), r(pick(1)).alias("p50"), r(pick(2)).alias("p75"), r(F.col("max")).alias("max"),
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top value and its frequency per text column; a tie goes to the smallest value."""
    counts = _long(df, columns, "string").where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    return counts.groupBy("variable").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), top["value"].alias("top"), (-top["neg"]).alias("freq")
    )


def missing_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percent of nulls per column, only columns that have some, most first. One pass over the data."""
    columns = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"), F.col("_n")) for c in columns])
    return (
        one.select(F.inline(rows)).where(F.col("missing") > 0)
        .select("column", "missing", (100 * F.col("missing") / F.col("_n")).alias("percent"))
        .orderBy(F.desc("percent"), "column")
    )


def absence_signal(df: DataFrame, columns: Sequence[str] = ("company", "agent"), target: str = S.TARGET) -> DataFrame:
    """Target rate with and without a value, per column."""
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).isNotNull().alias("present")) for c in columns]
    return (
        df.select(F.col(target).alias("y"), F.inline(F.array(*pairs)))
        .groupBy("variable", "present").agg(F.avg("y").alias("rate"), F.count(F.lit(1)).alias("n"))
    )


def lead_time_band(c: Column | str = "lead_time") -> Column:
    """Right-closed bands; a value beyond the last edge has none."""
    c = F.col(c) if isinstance(c, str) else c
    band = None
    for edge, name in S.LEAD_BANDS:
        hit = (c <= edge) & (c > -1)
        band = F.when(hit, name) if band is None else band.when(hit, name)
    return band


def rate_lead_band(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    order = F.when(F.lit(False), 0)
    for i, (_, name) in enumerate(S.LEAD_BANDS):
        order = order.when(F.col("band") == name, i)
    return (
        df.select(lead_time_band().alias("band"), F.col(target).alias("y")).where(F.col("band").isNotNull())
        .groupBy("band").agg(F.avg("y").alias("rate"), F.count(F.lit(1)).alias("n")).orderBy(order)
    )


def rate_deposit(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return rate_by(df, "deposit_type", target).orderBy("rate", "value")


def leak_by_scope(df: DataFrame, flag: Column, scope: Column, target: str = S.TARGET) -> DataFrame:
    """Target rate per flag over all rows and over the rows in scope, from one pass."""
    return (
        df.where(flag.isNotNull()).groupBy(flag.alias("flag"))
        .agg(
            F.count(F.lit(1)).alias("n_all"), F.avg(target).alias("rate_all"),
            F.count_if(scope).alias("n_scope"), F.avg(F.when(scope, F.col(target))).alias("rate_scope"),
        )
        .select("flag", F.inline(F.array(
            F.struct(F.lit("all").alias("scope"), F.col("n_all").alias("n"), F.col("rate_all").alias("rate")),
            F.struct(F.lit("No Deposit").alias("scope"), F.col("n_scope").alias("n"), F.col("rate_scope").alias("rate")),
        )))
    )


def leak_parking(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return leak_by_scope(df, F.col("required_car_parking_spaces") > 0, F.col("deposit_type") == "No Deposit", target)


def leak_room(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    moved = F.col("reserved_room_type") != F.col("assigned_room_type")
    return df.where(moved.isNotNull()).groupBy(moved.alias("moved")).agg(F.avg(target).alias("rate"), F.count(F.lit(1)).alias("n"))


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, via one grouping instead of one distinct set per column."""
    pairs = _long(df, columns, "string").where(F.col("value").isNotNull()).distinct()
    return pairs.groupBy("variable").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Most frequent non-null values; ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), "value")
    return ordered.limit(k) if k else ordered


def form_options(df: DataFrame) -> DataFrame:
    """Options per form field as (field, position, value).

    All fields are counted in one grouping; the top lists and the orders work on counts."""
    plain = [c for c in S.CATEGORICAL if c not in S.RARE_COLUMNS]
    counts = _long(df, S.CATEGORICAL, "string").where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    month = F.array_position(F.array(*map(F.lit, S.MONTHS)), F.col("value"))
    is_month = F.col("variable") == "arrival_date_month"
    by_name = Window.partitionBy("variable").orderBy(F.when(is_month, month).otherwise(0), "value")
    short = counts.where(F.col("variable").isin(plain) & (~is_month | (month > 0))).withColumn("position", F.row_number().over(by_name))
    # Identifiers may have very many values: the fixed rank limit is applied inside the tasks before the shuffle.
    caps = {"country": S.TOP_COUNTRIES, "agent": S.TOP_AGENTS, "company": S.TOP_COMPANIES}
    by_count = Window.partitionBy("variable").orderBy(F.desc("n"), "value")
    top = counts.where(F.col("variable").isin(list(caps))).withColumn("position", F.row_number().over(by_count)).where(F.col("position") <= max(caps.values()))
    cap = F.create_map(*[F.lit(x) for pair in caps.items() for x in pair])[F.col("variable")]
    listed = short.unionByName(top.where(F.col("position") <= cap)).select(F.col("variable").alias("field"), "position", "value")
    shifted = listed.withColumn("position", F.col("position") + F.when(F.col("field") == "company", 1).otherwise(0))
    n_agents = F.count_if(F.col("field") == "agent")
    extra = listed.agg(n_agents.alias("n")).select(F.inline(F.array(
        F.struct(F.lit("agent").alias("field"), (F.col("n") + 1).cast("int").alias("position"), F.lit(S.RARE_NULL_LABELS["agent"]).alias("value")),
        F.struct(F.lit("company").alias("field"), F.lit(1).alias("position"), F.lit(S.RARE_NULL_LABELS["company"]).alias("value")),
    )))
    return shifted.unionByName(extra)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = top_values(df, column)
    return counts.select("value", "n", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("share"))


def duplicate_rows(df: DataFrame, digest_text: bool = False) -> DataFrame:
    """Rows that repeat an earlier row. With `digest_text`, long texts travel as 256-bit digests."""
    if digest_text:
        df = df.withColumns({f.name: F.sha2(f.name, 256) for f in df.schema if isinstance(f.dataType, T.StringType)})
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present; long form, both halves.

    One pass forms all cross products; a pair without variance gives null."""
    columns = list(columns)
    # The mean as origin keeps the sums of squares small; a column without a number has 0.
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
    origin = df.agg(*[F.avg(F.when(F.abs(x) < float("inf"), x)).alias(f"m{i}") for i, x in enumerate(numbers)]).first()
    sums = pair_sums(df, columns, [x or 0.0 for x in origin])
    # sxx of (j, i) is the sum of x_j^2 where both are present.
    other = sums.select(F.col("i").alias("_j"), F.col("j").alias("_i"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    both = sums.join(other, (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")))
    n = F.when(F.col("n") > 0, F.col("n"))
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    flat = n.isNull() | (vx <= 1e-12 * F.col("sxx")) | (vy <= 1e-12 * F.col("syy")) | (n < 2)
    r = F.when(~flat, (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(vx * vy))
    names = F.array(*map(F.lit, columns))
    return both.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), r.alias("r"))


def corr_rank(df: DataFrame, columns: Sequence[str], against: str) -> DataFrame:
    one = df.agg(*[F.nanvl(F.corr(F.col(c).cast("double"), F.col(against).cast("double")), F.lit(None).cast("double")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("r")) for c in columns])
    return one.select(F.inline(rows)).orderBy(F.desc_nulls_last(F.abs("r")), "variable")


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Counts and row percentages of `col` per `row`; one column pair per value of `col`."""
    if values is None:
        values = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(1001).collect()]
        if len(values) > 1000:
            raise ValueError(f"{col} has too many values for columns; use value_counts")
    base = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    counts = base.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(f"n_{v}") for v in values], F.count(F.lit(1)).alias("_all"))
    return counts.select(row, *[f"n_{v}" for v in values], *[(100 * F.col(f"n_{v}") / F.col("_all")).alias(f"pct_{v}") for v in values])


def group_min_mean_max(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    aggs = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(*aggs)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max, the last one closed on the right; empty bins are listed."""
    v = F.col(column).cast("double")
    low, high = df.agg(F.min(v), F.max(v)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    width = (high - low) / bins or 1.0
    slot = F.least(F.floor((v - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"), (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def table_info(df: DataFrame) -> DataFrame:
    """Position, type, rows and non-null values per column."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col("_n").alias("rows"), F.col(f.name).alias("non_null"))
        for i, f in enumerate(df.schema)
    ]
    return one.select(F.inline(F.array(*rows)))


def delta_vs_base(df: DataFrame, probability: str, base: float = S.BASE_RATE) -> DataFrame:
    """Distance of a probability from the base rate, in percentage points."""
    return df.withColumn("delta_points", (F.col(probability) - F.lit(base)) * 100)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


def union_target(train: DataFrame, test: DataFrame, target: str = S.TARGET) -> DataFrame:
    return train.select(target).unionByName(test.select(target))
