"""Exact evaluation of scored frames. A score frame has y (0/1), p, pred and optionally group columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.hashing import row_hash
from staymill.functions.normal import normal_quantile
from staymill.plans.distributed import running_sums


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _counts() -> tuple[Column, Column, Column, Column]:
    y, q = F.col("y"), F.col("pred")
    return tuple(F.count_if((y == a) & (q == b)) for a, b in ((1, 1), (0, 1), (1, 0), (0, 0)))


def binary_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1 per group; a zero denominator gives 0."""
    tp, fp, fn, tn = _counts()
    c = df.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return c.select(
        *by, _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _by_score(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by, F.col("p").cast("double").alias("p")).agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties counted half; null if a class is missing.

    Rows become one row per distinct score first; running counts then use bucket offsets."""
    runs = running_sums(_by_score(df, by), "p", ["neg"], by)
    area = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    pos, neg = F.sum("pos"), F.sum("neg")
    return runs.groupBy(*by).agg(F.when((pos > 0) & (neg > 0), area / (pos.cast("double") * neg)).alias("roc_auc"))


def roc_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, highest first, plus the origin at infinity; the rate of an absent class is null."""
    scores = _by_score(df, by)
    runs = running_sums(scores, "p", ["pos", "neg"], by, descending=True)
    totals = scores.groupBy(*[F.col(c).alias(f"_g_{c}") for c in by]).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    if by:
        cond = F.lit(True)
        for c in by:
            cond = cond & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        runs = runs.join(totals, cond)
        origin = totals.select(*[F.col(f"_g_{c}").alias(c) for c in by])
    else:
        one = totals.first()
        runs = runs.withColumns({"_pos": F.lit(one["_pos"]), "_neg": F.lit(one["_neg"])})
        origin = totals.select()
    points = runs.select(*by, F.col("p").alias("threshold"), F.try_divide("cum_neg", "_neg").alias("fpr"), F.try_divide("cum_pos", "_pos").alias("tpr"))
    start = origin.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All four cells per group, empty ones as 0."""
    tp, fp, fn, tn = _counts()
    c = df.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    cells = [F.struct(F.lit(y).alias("y"), F.lit(q).alias("pred"), F.col(n).alias("n")) for y, q, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))]
    return c.select(*by, F.inline(F.array(*cells)))


def evaluate_models(scores: DataFrame, by: str = "model") -> DataFrame:
    """All five metrics per model from one long score frame."""
    auc = roc_auc(scores, [by]).withColumnRenamed(by, "_m")
    return binary_metrics(scores, [by]).join(auc, F.col(by) == F.col("_m")).drop("_m").select(by, *S.METRICS)


def comparison_table(metrics: DataFrame, order: Sequence[str] | None = None, primary: str = "roc_auc", by: str = "model") -> DataFrame:
    """Best first; equal values keep the given model order (or the name order)."""
    tie = F.array_position(F.array(*map(F.lit, order)), F.col(by)) if order else F.col(by)
    return metrics.orderBy(F.desc(primary), tie)


def select_best(metrics: DataFrame, order: Sequence[str] | None = None, primary: str = "roc_auc", by: str = "model") -> DataFrame:
    return comparison_table(metrics, order, primary, by).limit(1)


def classification_report(df: DataFrame) -> DataFrame:
    """precision, recall, f1, support per class, then accuracy, macro and weighted means."""
    cells = df.groupBy("y", "pred").agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"), F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("pred").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"), F.lit(0).cast("bigint").alias("tp")),
    )))
    per = sides.groupBy("c").agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("tp").alias("tp"))
    tp, called, support = map(F.col, ("tp", "called", "support"))
    rows = per.select(
        F.col("c").cast("string").alias("label"), _ratio(tp, called).alias("precision"), _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, called + support).alias("f1"), "support", "tp",
    )
    total = F.sum("support")
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / total
    null = F.lit(None).cast("double")
    def row(label, a, b, c):
        return F.struct(F.lit(label).alias("label"), a.alias("precision"), b.alias("recall"), c.alias("f1"), F.col("_t").alias("support"))
    sums = rows.agg(
        total.alias("_t"), (F.sum("tp") / total).alias("_acc"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")], *[weighted(c).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    )
    means = sums.select(F.inline(F.array(
        row("accuracy", null, null, F.col("_acc")),
        row("macro avg", F.col("m_precision"), F.col("m_recall"), F.col("m_f1")),
        row("weighted avg", F.col("w_precision"), F.col("w_recall"), F.col("w_f1")),
    )))
    return rows.drop("tp").unionByName(means)


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Metrics at each threshold: rows are counted once per threshold interval, not once per threshold."""
    cuts = sorted(thresholds)
    slot = F.lit(0)
    for t in cuts:
        slot = slot + F.when(F.col("p") >= t, 1).otherwise(0)
    n = df.groupBy(*by, slot.alias("slot")).agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    wide = n.groupBy(*by).agg(
        *[F.sum(F.when(F.col("slot") > i, F.col(c)).otherwise(0)).alias(f"{c}{i}") for i in range(len(cuts)) for c in ("pos", "neg")],
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
    )
    rows = []
    for i, t in enumerate(cuts):
        tp, fp = F.col(f"pos{i}"), F.col(f"neg{i}")
        fn, tn = F.col("P") - tp, F.col("N") - fp
        rows.append(F.struct(
            F.lit(float(t)).alias("threshold"), _ratio(tp + tn, F.col("P") + F.col("N")).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"),
            _ratio(tp, F.col("P")).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ))
    return wide.select(*by, F.inline(F.array(*rows)))


# --- Regression ---------------------------------------------------------------


def regression_metrics(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    e = F.col(y) - F.col(p)
    sse, n = F.sum(e * e), F.count(e)
    sst = F.var_pop(F.when(e.isNotNull(), F.col(y))) * n
    return df.groupBy(*by).agg(
        (sse / n).alias("mse"), F.sqrt(sse / n).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.when(sst > 0, 1 - sse / sst).alias("r2")
    )


def residuals(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(p))


def residual_summary(df: DataFrame, column: str = "residual") -> DataFrame:
    return df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"))


def qq_points(df: DataFrame, key: str, column: str = "residual", chunks: int = 64) -> DataFrame:
    """(position, prob, theoretical, value): ordered values against normal quantiles.

    Equal values are counted first; their positions are unrolled in hash chunks, so one very
    frequent value is spread over many tasks."""
    value = F.col(column).cast("double")
    base = df.where(value.isNotNull()).select(value.alias("value"), (row_hash(key) % chunks).alias("chunk"))
    pieces = base.groupBy("value", "chunk").agg(F.count(F.lit(1)).alias("m"))
    n = base.count()
    per_value = pieces.groupBy("value").agg(F.sum("m").alias("n"))
    starts = running_sums(per_value, "value", ["n"]).select(F.col("value").alias("_v"), (F.col("cum_n") - F.col("n")).alias("start"))
    inside = Window.partitionBy("value").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("before", F.coalesce(F.sum("m").over(inside), F.lit(0))).join(starts, F.col("value") == F.col("_v"))
    first = F.col("start") + F.col("before")
    rows = placed.repartition("value", "chunk").select("value", F.explode(F.sequence(first + 1, first + F.col("m"))).alias("position"))
    i = F.col("position")
    prob = (
        F.when(i == n, F.lit(0.5 ** (1.0 / n) if n else None))
        .when(i == 1, F.lit(1 - 0.5 ** (1.0 / n) if n else None))
        .otherwise((i - 0.3175) / F.lit(n + 0.365))
    )
    return rows.withColumn("prob", prob).select("position", "prob", normal_quantile(F.col("prob")).alias("theoretical"), "value")


def qq_line(points: DataFrame) -> DataFrame:
    return points.agg(F.regr_slope("value", "theoretical").alias("slope"), F.regr_intercept("value", "theoretical").alias("intercept"), F.corr("value", "theoretical").alias("r"))
