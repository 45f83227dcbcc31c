"""Evaluation and scoring over formula scores."""

from __future__ import annotations

from staymill.catalog.base import F, S, bookings, frame_cleaned, frame_scores, query, table, with_frames
from staymill.functions.session import scratch_path
from staymill.functions.normal import normal_quantile_sql
from staymill.operators import metrics as M
from staymill.operators import profile as P
from staymill.operators import registry as R
from staymill.operators import score as SC
from staymill.sources import store as ST

J = lambda body: with_frames("judged", body)
MT = lambda body: with_frames("metrics", body)
CL = lambda body: with_frames("cleaned", body)
MODELS = ("alpha", "beta", "gamma")


def _one(s, d, name="alpha"):
    return frame_scores(s, d, (name,))


query("binary_metrics", "model:s accuracy:d precision:d recall:d f1:d", MT("SELECT * FROM metrics"))(lambda s, d: M.binary_metrics(frame_scores(s, d), ["model"]))
query("roc_auc", "model:s roc_auc:d", MT("SELECT * FROM metrics"))(lambda s, d: M.roc_auc(frame_scores(s, d), ["model"]))
query("roc_curve", "model:s threshold:d fpr:d tpr:d", J(""", g AS (SELECT model, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM judged GROUP BY 1, 2)
SELECT model, p AS threshold, sum(neg) OVER w / sum(neg) OVER (PARTITION BY model) AS fpr, sum(pos) OVER w / sum(pos) OVER (PARTITION BY model) AS tpr FROM g
WINDOW w AS (PARTITION BY model ORDER BY p DESC)
UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0, 0 FROM judged"""))(lambda s, d: M.roc_curve(frame_scores(s, d), ["model"]))
query("confusion_matrix", "model:s y:i pred:i n:i", J("""
SELECT m.model, a.i AS y, b.i AS pred, (SELECT count(*) FROM judged j WHERE j.model = m.model AND j.y = a.i AND j.pred = b.i) AS n
FROM (SELECT DISTINCT model FROM judged) m, range(2) a(i), range(2) b(i)"""))(lambda s, d: M.confusion_matrix(frame_scores(s, d), ["model"]))
_METRIC_SPEC = "model:s accuracy:d precision:d recall:d f1:d roc_auc:d"
query("evaluate_models", _METRIC_SPEC, MT("SELECT * FROM metrics"))(lambda s, d: M.evaluate_models(frame_scores(s, d)))
query("comparison_table", _METRIC_SPEC, MT("SELECT * FROM metrics ORDER BY roc_auc DESC, position"))(
    lambda s, d: M.comparison_table(M.evaluate_models(frame_scores(s, d)), MODELS))
query("select_best", _METRIC_SPEC, MT("SELECT * FROM metrics ORDER BY roc_auc DESC, position LIMIT 1"))(
    lambda s, d: M.select_best(M.evaluate_models(frame_scores(s, d)), MODELS))


def _three_classes(s, d):
    """Three classes of lead time against a guess from the rate."""
    return frame_cleaned(s, d).select(
        F.when(F.col("lead_time") < 50, 0).when(F.col("lead_time") < 200, 1).otherwise(2).alias("y"),
        F.when(F.col("adr") < 1000, 0).when(F.col("adr") < 4000, 1).otherwise(2).alias("pred"))


query("classification_report", "label:s precision:d recall:d f1:d support:i", CL(""", t AS (SELECT
  CASE WHEN lead_time < 50 THEN 0 WHEN lead_time < 200 THEN 1 ELSE 2 END AS y, CASE WHEN adr < 1000 THEN 0 WHEN adr < 4000 THEN 1 ELSE 2 END AS pred FROM cleaned),
r AS (SELECT CAST(c.i AS VARCHAR) AS label, CAST(count(*) FILTER (WHERE y = c.i AND pred = c.i) AS DOUBLE) AS tp, count(*) FILTER (WHERE pred = c.i) AS called,
  count(*) FILTER (WHERE y = c.i) AS support FROM t, range(3) c(i) GROUP BY c.i),
m AS (SELECT label, CASE WHEN called = 0 THEN 0 ELSE tp / called END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, 2 * tp / (called + support) AS f1, support, tp FROM r)
SELECT label, precision, recall, f1, support FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM m
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM m"""))(
    lambda s, d: M.classification_report(_three_classes(s, d)))
_CUTS = [i / 20 for i in range(1, 20)]
query("threshold_sweep", "model:s threshold:d accuracy:d precision:d recall:d f1:d", J(""", c AS (SELECT model, i / 20.0 AS threshold,
  CAST(count(*) FILTER (WHERE y = 1 AND p >= CAST(i AS DOUBLE) / 20) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE y = 0 AND p >= CAST(i AS DOUBLE) / 20) AS DOUBLE) AS fp,
  count(*) FILTER (WHERE y = 1) AS pp, count(*) FILTER (WHERE y = 0) AS nn FROM judged, range(1, 20) r(i) GROUP BY 1, 2)
SELECT model, threshold, (tp + nn - fp) / (pp + nn) AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, tp / pp AS recall,
  CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (tp + fp + pp) END AS f1 FROM c"""))(lambda s, d: M.threshold_sweep(frame_scores(s, d), _CUTS, ["model"]))

# --- Regression on line items: price in thousands against a formula ----------------------

_LINE = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 1000 AS y, l_quantity * 1.5 + CAST(l_partkey % 7 AS DOUBLE) AS p FROM lineitem"


def _lines(s, d):
    return table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / 1000).alias("y"),
        (F.col("l_quantity") * 1.5 + (F.col("l_partkey") % 7).cast("double")).alias("p"))


query("regression_metrics", "mse:d rmse:d mae:d r2:d", f"""
WITH t AS ({_LINE}) SELECT avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2 FROM t""")(
    lambda s, d: M.regression_metrics(_lines(s, d)))
query("residual_summary", "mean:d std:d min:d max:d", f"WITH t AS ({_LINE}) SELECT avg(y - p) AS mean, stddev_samp(y - p) AS std, min(y - p) AS min, max(y - p) AS max FROM t")(
    lambda s, d: M.residual_summary(M.residuals(_lines(s, d))))
query("residual_pairs", "l_orderkey:i l_linenumber:i p:d residual:d", f"WITH t AS ({_LINE}) SELECT l_orderkey, l_linenumber, p, y - p AS residual FROM t")(
    lambda s, d: M.residuals(_lines(s, d)))
_QQ = f"""
WITH t AS ({_LINE}), o AS (SELECT row_number() OVER (ORDER BY y - p) AS position, y - p AS value, count(*) OVER () AS n FROM t),
q AS (SELECT position, CASE WHEN position = n THEN pow(0.5, 1.0 / n) WHEN position = 1 THEN 1 - pow(0.5, 1.0 / n)
  ELSE (CAST(position AS DOUBLE) - CAST(0.3175 AS DOUBLE)) / (n + CAST(0.365 AS DOUBLE)) END AS prob, value FROM o),
points AS (SELECT position, prob, {normal_quantile_sql('prob')} AS theoretical, value FROM q)
"""


def _qq(s, d):
    return M.qq_points(M.residuals(_lines(s, d)).withColumn("line", F.struct("l_orderkey", "l_linenumber", "l_partkey")), "line")


query("qq_points", "position:i prob:d theoretical:d value:d", _QQ + "SELECT * FROM points")(_qq)
query("qq_line", "slope:d intercept:d r:d", _QQ + "SELECT regr_slope(value, theoretical) AS slope, regr_intercept(value, theoretical) AS intercept, corr(value, theoretical) AS r FROM points")(
    lambda s, d: M.qq_line(_qq(s, d)))

# --- Scoring -----------------------------------------------------------------------------

_FINE = "CAST((booking_id * 40503) % 99991 AS DOUBLE) / 99991"


def _fine(s, d):
    return bookings(s, d).select("booking_id", (F.pmod(F.col("booking_id") * 40503, F.lit(99991)).cast("double") / 99991).alias("p"))


query("threshold_rounding", "booking_id:i prediction:i probability_canceled:e", with_frames("bookings", f"""
SELECT booking_id, CASE WHEN {_FINE} >= 0.5 THEN 1 ELSE 0 END AS prediction, round_even({_FINE}, 4) AS probability_canceled FROM bookings"""))(
    lambda s, d: _fine(s, d).select("booking_id", *[c.alias(n) for n, c in SC.decide(F.col("p")).items()]))
query("label_result", "booking_id:i prediction:i label:s", with_frames("bookings", f"""
SELECT booking_id, CASE WHEN {_FINE} >= 0.5 THEN 1 ELSE 0 END AS prediction, CASE WHEN {_FINE} >= 0.5 THEN 'Cancelada' ELSE 'No cancelada' END AS label FROM bookings"""))(
    lambda s, d: SC.label_result(_fine(s, d).select("booking_id", *[c.alias(n) for n, c in SC.decide(F.col("p")).items()])))
query("extreme_rows", "example:s booking_id:i p:d", J("""
(SELECT 'alta_prob' AS example, booking_id, p FROM judged WHERE model = 'alpha' ORDER BY p DESC, booking_id LIMIT 1)
UNION ALL (SELECT 'baja_prob', booking_id, p FROM judged WHERE model = 'alpha' ORDER BY p, booking_id LIMIT 1)"""))(
    lambda s, d: SC.extreme_rows(_one(s, d)))

# --- Metric tables and stores ----------------------------------------------------------------


def _metrics(s, d):
    return M.evaluate_models(frame_scores(s, d))


query("melt_metrics", "model:s metric:s value:d", MT(" UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM metrics" for m in S.METRICS)))(
    lambda s, d: P.melt(_metrics(s, d), ["model"], S.METRICS))
query("metrics_markdown", "position:i line:s", MT(""", o AS (SELECT *, row_number() OVER (ORDER BY roc_auc DESC, model) + 1 AS line FROM metrics)
SELECT 0 AS position, '| Modelo | accuracy | precision | recall | f1 | roc_auc |' AS line UNION ALL SELECT 1, '|---|---|---|---|---|---|'
UNION ALL SELECT line, '| ' || model || ' | ' || format('{:.4f} | {:.4f} | {:.4f} | {:.4f} | {:.4f}', accuracy, precision, recall, f1, roc_auc) || ' |' FROM o"""))(
    lambda s, d: ST.markdown_lines(ST.read_metrics(s, ST.write_metrics(_metrics(s, d), scratch_path(s, "metrics")))))
query("best_metric", "metric:s value:d", MT("SELECT 'roc_auc' AS metric, max(roc_auc) AS value FROM metrics"))(
    lambda s, d: ST.best_metric(ST.read_metrics(s, ST.write_metrics(_metrics(s, d), scratch_path(s, "metrics")))))


@query("params_roundtrip", "model:s trees:i max_depth:i rate:d", with_frames("cleaned", """
SELECT customer_type AS model, count(*) AS trees, CASE WHEN customer_type <> 'Group' THEN max(lead_time) END AS max_depth, CASE WHEN customer_type <> 'Group' THEN avg(is_canceled) END AS rate
FROM cleaned GROUP BY 1""").replace("count(*) AS trees", "CASE WHEN customer_type <> 'Group' THEN count(*) END AS trees"))
def params_roundtrip(s, d):
    """Parameters per group of bookings; the row of one group is damaged and must come back empty."""
    stats = frame_cleaned(s, d).groupBy(F.col("customer_type").alias("model")).agg(
        F.count(F.lit(1)).alias("trees"), F.max("lead_time").alias("max_depth"), F.avg("is_canceled").alias("rate"))
    store = ST.params_table(stats, "model").withColumn("params", F.when(F.col("model") == "Group", "{broken").otherwise(F.col("params")))
    path = scratch_path(s, "params")
    store.write.parquet(path)
    return ST.read_params(s, path, "trees bigint, max_depth int, rate double")


_VERSIONS = """, versions AS (SELECT market_segment AS name, row_number() OVER (PARTITION BY market_segment ORDER BY arrival_date_month) AS version, avg(lead_time) AS score,
  arrival_date_month AS run FROM cleaned GROUP BY market_segment, arrival_date_month),
staged AS (SELECT *, CASE WHEN version = 2 THEN 'Production' WHEN version = 3 THEN 'Staging' ELSE 'None' END AS stage FROM versions),
newest AS (SELECT name, max(version) AS version FROM staged GROUP BY name)"""


def _versions(s, d):
    """One model name per market segment, one version per month: made by the rows themselves."""
    runs = frame_cleaned(s, d).groupBy(F.col("market_segment").alias("name"), F.col("arrival_date_month").alias("run")).agg(F.avg("lead_time").alias("score"))
    return R.register(runs, order="run").withColumn("stage", F.when(F.col("version") == 2, "Production").when(F.col("version") == 3, "Staging").otherwise("None"))


query("promote_version", "name:s version:i run:s score:d stage:s", CL(f"""{_VERSIONS}
SELECT s.name, s.version, run, score, CASE WHEN s.version = n.version THEN 'Production' WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage
FROM staged s JOIN newest n ON s.name = n.name"""))(lambda s, d: (lambda v: R.promote(v, R.latest(v), "Production"))(_versions(s, d)))
query("lookup_version", "name:s version:i score:d", CL(f"{_VERSIONS} SELECT * FROM staged WHERE stage = 'Production'"))(lambda s, d: R.lookup(_versions(s, d), "Production"))
