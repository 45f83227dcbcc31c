"""Training, search, explanation, projection of bookings, and scoring jobs.

Models, searches and repeats have the sizes of schema.py."""

from __future__ import annotations

from functools import lru_cache
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml.functions import vector_to_array

from staymill.catalog.base import F, S, bookings, frame_cleaned, mix_sql, query, table, with_frames
from staymill.functions.session import materialise, scratch_path
from staymill.functions.vectors import slot_sums, width_and_filled
from staymill.operators import alike
from staymill.operators import encode as E
from staymill.operators import explain as X
from staymill.operators import metrics as MT
from staymill.operators import models as M
from staymill.operators import neighbours as N
from staymill.operators import plane as PL
from staymill.operators import project as PR
from staymill.operators import score as SC
from staymill.operators import split as SP
from staymill.operators import tune as TU
from staymill.plans import jobs as JB
from staymill.sources import store as ST
from staymill.sources.csv import write_csv
from staymill.streaming import score as STREAM

B = lambda body: with_frames("bookings", body)
CL = lambda body: with_frames("cleaned", body)
_SCORE_SPEC = "booking_id:i prediction:i probability_canceled:d"
_ORDER = mix_sql("booking_id", 42)
_METRIC_SPEC = "model:s accuracy:d precision:d recall:d f1:d roc_auc:d"


@lru_cache(maxsize=4)
def _prepared(spark, sf_dir):
    """Cleaned train and test rows, the fitted preprocessing and both prepared frames; written once per session."""
    train, test = JB.load_and_prepare(bookings(spark, sf_dir))
    pre, (tr, te) = M.prepare(train, test)
    return train, test, pre, tr, te


@lru_cache(maxsize=16)
def _model(spark, sf_dir, name):
    _, _, _, tr, _ = _prepared(spark, sf_dir)
    return M.catalogue(tr.count(), M.width_of(tr))[name].fit(tr)


def _pipeline(spark, sf_dir, name="Decision Tree"):
    return M.full_pipeline(_prepared(spark, sf_dir)[2], _model(spark, sf_dir, name))


def _names(spark, sf_dir):
    _, test, pre, _, _ = _prepared(spark, sf_dir)
    return E.feature_names(pre.transform(test))


# --- Single models --------------------------------------------------------------------

for _key, _name in (("fit_logreg", "Logistic Regression"), ("fit_tree", "Decision Tree"), ("fit_forest", "Random Forest"), ("fit_gbt", "Gradient Boosting"), ("fit_mlp", "Neural Network")):
    query(_key, _METRIC_SPEC)(lambda s, d, n=_name: M.evaluate({n: _model(s, d, n)}, _prepared(s, d)[4]))


@query("tree_leaf_shares", "booking_id:i is_share:b large_enough:b", with_frames("split", "SELECT booking_id, true AS is_share, true AS large_enough FROM split WHERE split = 'train'"))
def tree_leaf_shares(s, d):
    """Of every training row, whether the tree's probability is the class share of its leaf, and the leaf holds the least number of rows."""
    model = _model(s, d, "Decision Tree").copy()
    model.set(model.leafCol, "leaf")
    rows = model.transform(_prepared(s, d)[3]).select("booking_id", "label", "leaf", vector_to_array("probability")[1].alias("p"))
    leaves = rows.groupBy("leaf").agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n"))
    least = S.MODEL_PARAMS["Decision Tree"]["min_leaf"]
    return rows.join(leaves, "leaf").select("booking_id", (F.abs(F.col("p") - F.col("share")) < 1e-9).alias("is_share"), (F.col("n") >= least).alias("large_enough"))


@query("logreg_stationary", "training_rows:i intercept:b weights:b", with_frames("split", "SELECT count(*) AS training_rows, true AS intercept, true AS weights FROM split WHERE split = 'train'"))
def logreg_stationary(s, d):
    """Whether the gradient of the penalised mean loss vanishes at the fitted intercept and at every weight."""
    tr = _prepared(s, d)[3]
    model, n = _model(s, d, "Logistic Regression"), tr.count()
    miss = (vector_to_array("probability")[1] - F.col("label")).alias("miss")
    rows = model.transform(tr).select("features", miss)
    slope = slot_sums(rows, "features", lambda x, b: {"g": x.back(np.asarray(b.column("miss")))}, ["g"], F.col("miss"))["g"] / n
    worst = float(np.abs(slope + model.coefficients.toArray() / n).max())
    return rows.agg(F.count(F.lit(1)).alias("training_rows"), (F.abs(F.avg("miss")) < 1e-3).alias("intercept"), F.lit(worst < 1e-3).alias("weights"))


@query("fit_linear_svm", "accuracy:d precision:d recall:d f1:d roc_auc:d")
def fit_linear_svm(s, d):
    _, _, _, tr, te = _prepared(s, d)
    scored = M.linear_svm().fit(tr).transform(te).select(
        F.lit("svm").alias("model"), "booking_id", F.col("label").cast("int").alias("y"), vector_to_array("rawPrediction")[1].alias("p"), F.col("prediction").cast("int").alias("pred"))
    return MT.evaluate_models(materialise(scored))


@query("fit_logreg_multiclass", "label:s precision:d recall:d f1:d support:i")
def fit_logreg_multiclass(s, d):
    """Three classes: the first three labels of the embeddings."""
    df = SP.split_random(table(s, d, "embeddings").withColumn("y", F.col("label") % 3), key="vec_id")
    prep = materialise(PR.scaled_vectors(df, "embedding", out=E.FEATURES_COL).drop("label").withColumn("label", F.col("y").cast("double")))
    train = prep.where("split = 'train'")
    scored = M.logistic(train.count()).fit(train).transform(prep.where("split = 'test'"))
    return MT.classification_report(scored.select("y", F.col("prediction").cast("int").alias("pred")))


@query("gbt_early_stop", "trees:i max_trees:i roc_auc:d")
def gbt_early_stop(s, d):
    """A fifth of the training rows decides when to stop growing."""
    _, _, _, tr, te = _prepared(s, d)
    held = SP.split_random(tr, seed=7).withColumn("held_out", F.col("split") == "test")
    trees = S.MODEL_PARAMS["Gradient Boosting"]["trees"]
    model = M.boosting(**S.MODEL_PARAMS["Gradient Boosting"], validation="held_out").fit(held)
    auc = M.evaluate({"boosting": model}, te).first()["roc_auc"]
    return s.createDataFrame([(model.getNumTrees, trees, auc)], "trees int, max_trees int, roc_auc double")


@query("mlp_early_stop", "training_rows:i validation_rows:i loss_falls:b stops_early_or_ends:b best_kept:b", with_frames("split", f"""
, t AS (SELECT {mix_sql('booking_id', S.SEED + 1)} / 2147483647.0 < 0.2 AS held FROM split WHERE split = 'train')
SELECT count(*) FILTER (WHERE NOT held) AS training_rows, count(*) FILTER (WHERE held) AS validation_rows, true AS loss_falls, true AS stops_early_or_ends, true AS best_kept FROM t"""))
def mlp_early_stop(s, d):
    """The network's history: whether the loss falls, whether it ends after its patience or its epochs, and with the best weights."""
    from staymill.operators.network import Settings, held_out

    tr = _prepared(s, d)[3]
    model, limits = _model(s, d, "Neural Network"), Settings()
    held = tr.withColumn("held", held_out())
    losses, checks = zip(*model.history)
    best = checks.index(min(checks))
    p = vector_to_array("probability")[1]
    again = model.transform(held.where("held")).agg(F.avg(-F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]
    ended = len(checks) == limits.epochs or len(checks) - 1 - best == limits.patience
    counts = held.agg(F.count_if(~F.col("held")).alias("training_rows"), F.count_if("held").alias("validation_rows"))
    return counts.select("*", F.lit(losses[best] < losses[0]).alias("loss_falls"), F.lit(ended).alias("stops_early_or_ends"), F.lit(abs(again - checks[best]) < 1e-6).alias("best_kept"))


@query("train_all", _METRIC_SPEC)
def train_all(s, d):
    """All five models; their fits share nothing but the prepared rows and run side by side."""
    te = _prepared(s, d)[4]
    with ThreadPool(len(S.MODEL_PARAMS)) as pool:
        fitted = dict(pool.map(lambda n: (n, _model(s, d, n)), S.MODEL_PARAMS))
    return MT.comparison_table(M.evaluate(fitted, te), list(S.MODEL_PARAMS))



@query("train_times", "model:s seconds:d")
def train_times(s, d):
    _, _, _, tr, _ = _prepared(s, d)
    _, seconds = M.fit_all(M.catalogue(tr.count(), M.width_of(tr)), tr)
    return s.createDataFrame(list(seconds.items()), "model string, seconds double")


query("feature_importance", "rank:i feature:s importance:d")(lambda s, d: M.feature_importance(_model(s, d, "Random Forest"), _names(s, d), _prepared(s, d)[3]))
query("learning_curve", "iteration:i split:s loss:d")(lambda s, d: M.learning_curve(_model(s, d, "Gradient Boosting"), *_prepared(s, d)[3:5]))

# --- Balancing ------------------------------------------------------------------------------


def _smote_frame(tr):
    rows = tr.select("booking_id", F.col("label").cast("int").alias("label"), F.col("features").alias("v"))
    return N.smote(rows, "v", "label", "booking_id")


query("smote", "synthetic:i base:i neighbour:i u:d label:i width:i")(lambda s, d: _smote_frame(_prepared(s, d)[3]).withColumn("width", width_and_filled("v")[0]))


@query("smote_balance", "label:i n:i bases:i between:b", with_frames("split", """
, c AS (SELECT is_canceled AS label, count(*) AS n FROM split WHERE split = 'train' GROUP BY 1)
SELECT label, max(n) OVER () AS n, CASE WHEN label = 1 AND n < max(n) OVER () THEN least(n, max(n) OVER () - n) ELSE 0 END AS bases, true AS between FROM c"""))
def smote_balance(s, d):
    """Class sizes after oversampling, base rows used, and whether every new row lies between two minority rows."""
    tr = _prepared(s, d)[3].select("booking_id", F.col("label").cast("int").alias("label"), F.col("features").alias("v"))
    made = _smote_frame(_prepared(s, d)[3])
    def rows(k, v):
        return tr.select(F.col("booking_id").alias(k), F.col("v").alias(v))

    placed = made.join(rows("base", "_a"), "base").join(rows("neighbour", "_b"), "neighbour")
    judged = placed.select("label", F.col("base").alias("b"), alike.on_line(placed, "_a", "v", "_b").alias("ok"))
    both = tr.select("label", F.lit(None).cast("bigint").alias("b"), F.lit(True).alias("ok")).unionByName(judged)
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("b").alias("bases"), F.bool_and("ok").alias("between"))


@query("balancing_compare", "balance:s " + _METRIC_SPEC)
def balancing_compare(s, d):
    """Forest and boosting, each without balancing, with class weights and with synthetic rows."""
    _, _, _, tr, te = _prepared(s, d)
    extra = _smote_frame(tr).select(F.col("synthetic").alias("booking_id"), F.col("label").cast("double").alias("label"), F.col("v").alias("features"))
    sets = {
        "none": SP.add_weight(tr, "label").drop("weight").withColumn("weight", F.lit(1.0)),
        "weight": SP.add_weight(tr, "label"),
        "SMOTE": materialise(tr.select("booking_id", "label", "features").unionByName(extra)).withColumn("weight", F.lit(1.0)),
    }
    made = {"Random Forest": M.forest, "Gradient Boosting": M.boosting}
    jobs = [(f"{name}|{kind}", make(**S.MODEL_PARAMS[name], weight="weight"), rows) for kind, rows in sets.items() for name, make in made.items()]
    with ThreadPool(len(jobs)) as pool:  # six fits that share nothing
        fitted = dict(pool.map(lambda j: (j[0], j[1].fit(j[2])), jobs))
    out = M.evaluate(fitted, te)
    return out.withColumns({"balance": F.split("model", r"\|")[1], "model": F.split("model", r"\|")[0]})


# --- Search -----------------------------------------------------------------------------------


def _combo_rows(s, d, name, combos):
    train = _prepared(s, d)[0]
    rows = [(i, str(r["params"]), r["mean"], max(r["scores"]) - min(r["scores"])) for i, r in enumerate(TU.search(train, name, combos))]
    return s.createDataFrame(rows, "position int, params string, cv_roc_auc double, spread double").orderBy(F.desc("cv_roc_auc"), "position")


query("grid_search", "position:i params:s cv_roc_auc:d spread:d")(lambda s, d: _combo_rows(s, d, "Logistic Regression", TU.expand(S.GRIDS["Logistic Regression"])))
query("random_search", "position:i params:s cv_roc_auc:d spread:d")(lambda s, d: _combo_rows(s, d, "Decision Tree", TU.sample(S.GRIDS["Decision Tree"])))


@query("search_resume", "fits:i refitted:i same:b training_rows:i", with_frames("split", """
SELECT 6 AS fits, 0 AS refitted, true AS same, count(*) AS training_rows FROM split WHERE split = 'train'"""))
def search_resume(s, d):
    """A search of two trees over three folds whose ledger is read again: nothing is fitted twice, the best parameters come back."""
    train = _prepared(s, d)[0]
    out, grids = scratch_path(s, "search"), {"Decision Tree": {"max_depth": [6], "min_leaf": [20, 100]}}
    first, _ = TU.tune(train, ["Decision Tree"], grids, out=out)
    before = TU.read_ledger(s, f"{out}/ledger").select("*", "_metadata.file_path").collect()
    again, _ = TU.tune(train, ["Decision Tree"], grids, out=out)
    after = TU.read_ledger(s, f"{out}/ledger").select("*", "_metadata.file_path").collect()
    same = first == again == TU.best_params(s, out)
    return train.agg(F.lit(len(before)).alias("fits"), F.lit(len(set(after) - set(before))).alias("refitted"), F.lit(same).alias("same"), F.count(F.lit(1)).alias("training_rows"))


@query("tuning_report", "model:s search:s combinations:i cv_roc_auc:d seconds:d params:s")
def tuning_report(s, d):
    best, rows = TU.tune(_prepared(s, d)[0], list(S.GRIDS))
    return s.createDataFrame([(*r, str(best[r[0]])) for r in rows], "model string, search string, combinations int, cv_roc_auc double, seconds double, params string")


_GRID_COLUMNS = "model:s position:i C:d trees:i max_depth:i min_leaf:i rate:d reg_param:d leaf_share:d"


def _grid_sql() -> str:
    parts = []
    for name, grid in S.GRIDS.items():
        lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
        joins = ", ".join(f"(SELECT unnest([{', '.join(map(lit, vs))}]) AS \"{k}\", unnest(range({len(vs)})) AS i{n}) g{n}" for n, (k, vs) in enumerate(grid.items()))
        position, size = [], 1
        for n, vs in reversed(list(enumerate(grid.values()))):
            position.append(f"i{n} * {size}")
            size *= len(vs)
        col = lambda c: f'"{c}"' if c in grid else "NULL"
        depth = 'coalesce("max_depth", 30)' if "max_depth" in grid else "NULL"
        parts.append(f"SELECT '{name}' AS model, {' + '.join(position)} AS position, {col('C')} AS \"C\", {col('trees')} AS trees, {depth} AS max_depth, {col('min_leaf')} AS min_leaf, {col('rate')} AS rate FROM {joins}")
    return " UNION ALL ".join(parts)


@query("grid_expand", _GRID_COLUMNS, CL(f""", combos AS ({_grid_sql()})
SELECT *, 1 / (CAST("C" AS DOUBLE) * n) AS reg_param, CAST(min_leaf AS DOUBLE) / n AS leaf_share FROM combos, (SELECT CAST(count(*) AS DOUBLE) AS n FROM cleaned) t"""))
def grid_expand(s, d):
    """Every combination of every grid, with the parameters that depend on the number of rows resolved."""
    rows = []
    for name, grid in S.GRIDS.items():
        for i, p in enumerate(TU.expand(grid)):
            depth = (p["max_depth"] or S.SPARK_MAX_DEPTH) if "max_depth" in p else None
            rows.append((name, i, p.get("C"), p.get("trees"), depth, p.get("min_leaf"), p.get("rate")))
    combos = s.createDataFrame(rows, "model string, position int, C double, trees int, max_depth int, min_leaf int, rate double")
    n = frame_cleaned(s, d).count()
    return combos.withColumns({"reg_param": 1 / (F.col("C") * n), "leaf_share": F.col("min_leaf") / F.lit(float(n))})


@query("random_grid", "model:s combinations:i sampled:i different:i fits:i rows_read:i", CL("""
SELECT model, combos AS combinations, least(12, combos) AS sampled, least(12, combos) AS different, least(12, combos) * 3 AS fits, n * 2 * least(12, combos) AS rows_read
FROM (VALUES ('Random Forest', 54), ('Gradient Boosting', 540), ('Logistic Regression', 8), ('Decision Tree', 24)) v(model, combos), (SELECT count(*) AS n FROM cleaned) t"""))
def random_grid(s, d):
    """Size of each grid, of its random sample, and the training rows a 3-fold search over it reads."""
    n = frame_cleaned(s, d).count()
    rows = []
    for name, grid in S.GRIDS.items():
        picked = TU.sample(grid)
        rows.append((name, len(TU.expand(grid)), len(picked), len({str(p) for p in picked}), len(picked) * S.CV_FOLDS, n * (S.CV_FOLDS - 1) * len(picked)))
    return s.createDataFrame(rows, "model string, combinations int, sampled int, different int, fits int, rows_read bigint")


_CV = "SELECT booking_id, CAST(stays_in_week_nights AS DOUBLE) AS x, adr / 100 AS y, (row_number() OVER (ORDER BY {h}, booking_id) - 1) % 5 AS fold FROM cleaned"


@query("cv_linreg_r2", "fold:i r2:d", CL(f""", t AS ({_CV.format(h=_ORDER)}),
m AS (SELECT f.i AS fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM t, range(5) f(i) WHERE t.fold <> f.i GROUP BY 1)
SELECT t.fold, 1 - sum((y - a * x - b) * (y - a * x - b)) / (var_pop(y) * count(*)) AS r2 FROM t JOIN m ON t.fold = m.fold GROUP BY 1"""))
def cv_linreg_r2(s, d):
    df = frame_cleaned(s, d).select("booking_id", F.col("stays_in_week_nights").cast("double").alias("x"), (F.col("adr") / 100).alias("y"))
    def score(model, rows):
        return MT.regression_metrics(model.transform(rows).withColumn("p", F.col("prediction")), "label", "p").first()["r2"]
    scores = TU.cross_val_score(M.assemble(df, ["x"], "y", "booking_id"), M.linear, score, 5)
    return s.createDataFrame([(i, float(v)) for i, v in enumerate(scores)], "fold int, r2 double")


# --- Regression models over line items ----------------------------------------------------------

_LINE_X = ["l_quantity", "l_discount", "l_tax"]
_REG_SPEC = "model:s mse:d rmse:d mae:d r2:d"


def _lines(s, d, columns=_LINE_X):
    df = table(s, d, "lineitem").withColumns({"y": F.col("l_extendedprice") / 1000, "id": F.col("l_orderkey") * 8 + F.col("l_linenumber")})
    return M.assemble(df, list(columns), "y", "id")


@query("linreg_simple", "slope:d intercept:d r2:d formula:s", """
SELECT regr_slope(l_extendedprice / 1000, l_quantity) AS slope, regr_intercept(l_extendedprice / 1000, l_quantity) AS intercept, regr_r2(l_extendedprice / 1000, l_quantity) AS r2,
  format('y = {:.4f} {} {:.4f} * l_quantity', regr_intercept(l_extendedprice / 1000, l_quantity), CASE WHEN regr_slope(l_extendedprice / 1000, l_quantity) >= 0 THEN '+' ELSE '-' END,
    abs(regr_slope(l_extendedprice / 1000, l_quantity))) AS formula FROM lineitem""")
def linreg_simple(s, d):
    m = M.linear(_lines(s, d, ["l_quantity"]))
    return s.createDataFrame([(float(m.coefficients[0]), float(m.intercept), float(m.summary.r2), M.formula(m, ["l_quantity"]))], "slope double, intercept double, r2 double, formula string")


def _coefs(s, m, names):
    return s.createDataFrame([("intercept", float(m.intercept)), *[(n, float(c)) for n, c in zip(names, m.coefficients)]], "term string, value double")


_LINE_SQL = """WITH RECURSIVE t AS (SELECT CAST(l_extendedprice AS DOUBLE) / 1000 AS y, CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) AS b, CAST(l_tax AS DOUBLE) AS c FROM lineitem)"""
_LINE_MOMENTS = """m AS (SELECT count(*) AS n, avg(y) AS y, avg(a) AS a, avg(b) AS b, avg(c) AS c, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(c) AS cc,
  covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, covar_pop(c, y) AS cy FROM {rows})"""
_LINE_STANDARD = "z AS (SELECT y, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS a, (b - avg(b) OVER ()) / stddev_pop(b) OVER () AS b, (c - avg(c) OVER ()) / stddev_pop(c) OVER () AS c FROM t)"
_LINE_TERMS = """SELECT 'intercept' AS term, y - wa * a - wb * b - wc * c AS value FROM m, w UNION ALL SELECT 'l_quantity', wa FROM w
UNION ALL SELECT 'l_discount', wb FROM w UNION ALL SELECT 'l_tax', wc FROM w"""


def _normal_sql(rows: str, ridge: float) -> str:
    """Normal equations of three columns, solved by determinants; `ridge` is the penalty on the summed squares."""
    return f"""{_LINE_SQL}, {_LINE_STANDARD}, {_LINE_MOMENTS.format(rows=rows)}, r AS (SELECT * REPLACE (aa + {ridge} / n AS aa, bb + {ridge} / n AS bb, cc + {ridge} / n AS cc) FROM m),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM r),
w AS (SELECT (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det AS wa,
  (aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det AS wb,
  (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM d)
{_LINE_TERMS}"""


def _lasso_sql(penalty: float) -> str:
    """100 rounds of coordinate descent on the moments of the standardised columns."""
    soft = lambda g, v: f"(sign({g}) * greatest(abs({g}) - {penalty}, 0) / {v})"
    return f"""{_LINE_SQL}, {_LINE_STANDARD}, {_LINE_MOMENTS.format(rows="z")},
run(i, wa, wb, wc) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
  SELECT i + 1, na, nb, {soft("(cy - ac * na - bc * nb)", "cc")} FROM (
    SELECT *, {soft("(by_ - ab * na - bc * wc)", "bb")} AS nb FROM (
      SELECT *, {soft("(ay - ab * wb - ac * wc)", "aa")} AS na FROM run, m WHERE i < 100) one) two),
w AS (SELECT wa, wb, wc FROM run WHERE i = 100)
{_LINE_TERMS}"""


query("linreg_multi", "term:s value:d", _normal_sql("t", 0.0))(lambda s, d: _coefs(s, M.linear(_lines(s, d)), _LINE_X))


def _standard_lines(s, d):
    df = table(s, d, "lineitem").withColumns({"y": F.col("l_extendedprice") / 1000, "id": F.col("l_orderkey")}).select("id", "y", *_LINE_X)
    return M.assemble(E.StandardScaler(columns=_LINE_X).fit(df).transform(df), _LINE_X, "y")


query("ridge", "term:s value:d", _normal_sql("z", 10.0))(lambda s, d: _coefs(s, M.linear(_standard_lines(s, d), ridge=10.0), _LINE_X))
# To four decimals, which is as far as the quasi-Newton fit goes.
query("lasso", "term:s value:d", f"SELECT term, round(value, 4) AS value FROM ({_lasso_sql(0.1)}) r")(
    lambda s, d: _coefs(s, M.linear(_standard_lines(s, d), lasso=0.1), _LINE_X).withColumn("value", F.round("value", 4)))


def _regression(s, d, name, estimator):
    df = SP.split_random(_lines(s, d), key="id")
    out = estimator.fit(df.where("split = 'train'")).transform(df.where("split = 'test'"))
    return MT.regression_metrics(out.withColumn("p", F.col("prediction")), "label", "p").withColumn("model", F.lit(name))


query("fit_tree_reg", _REG_SPEC)(lambda s, d: _regression(s, d, "tree", M.tree_regressor(maxDepth=6)))
query("fit_forest_reg", _REG_SPEC)(lambda s, d: _regression(s, d, "forest", M.forest_regressor(maxDepth=6, numTrees=200)))
query("fit_gbt_reg", _REG_SPEC)(lambda s, d: _regression(s, d, "boosting", M.boosting_regressor(maxDepth=4, maxIter=300)))


@query("degree_compare", "degree:i split:s mse:d r2:d")
def degree_compare(s, d):
    """Polynomials of degree 1, 2 and 15 on a unit-scaled quantity: errors on train and test."""
    from pyspark.ml.feature import PolynomialExpansion

    df = table(s, d, "lineitem").withColumns({"x": F.col("l_quantity") / 50, "y": F.col("l_extendedprice") / 1000, "id": F.col("l_orderkey")})
    df = materialise(SP.split_random(M.assemble(df, ["x"], "y", "id"), key="id"))
    out = None
    for degree in (1, 2, 15):
        grown = PolynomialExpansion(degree=degree, inputCol=E.FEATURES_COL, outputCol="poly").transform(df).drop(E.FEATURES_COL).withColumnRenamed("poly", E.FEATURES_COL)
        scored = M.linear(grown.where("split = 'train'")).transform(grown).withColumn("p", F.col("prediction"))
        one = MT.regression_metrics(scored, "label", "p", ["split"]).select(F.lit(degree).alias("degree"), "split", "mse", "r2")
        out = one if out is None else out.unionByName(one)
    return out


# --- Explanation -----------------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _shap(s, d):
    return materialise(X.shap_values(_model(s, d, "Gradient Boosting"), X.shap_sample(_prepared(s, d)[4])), "shap")


query("shap_global", "feature:s mean_abs:d additive:b")(lambda s, d: X.shap_global(_shap(s, d), _names(s, d)))
query("shap_points", "booking_id:i feature:s feature_value:d shap:d")(lambda s, d: X.shap_points(_shap(s, d), _names(s, d)))


@query("shap_local", "booking_id:i position:i feature:s feature_value:d shap:d")
def shap_local(s, d):
    scored = _model(s, d, "Gradient Boosting").transform(_prepared(s, d)[4]).select("booking_id", vector_to_array("probability")[1].alias("p"))
    keys = [r["booking_id"] for r in SC.extreme_rows(scored).collect()]
    chosen = X.shap_values(_model(s, d, "Gradient Boosting"), _prepared(s, d)[4].where(F.col("booking_id").isin(keys)))
    return X.shap_local(chosen, _names(s, d), keys)


query("permutation_importance", "feature:s importance_mean:d importance_std:d")(lambda s, d: X.permutation_importance(_pipeline(s, d, "Logistic Regression"), _prepared(s, d)[1]))
query("permute_column", "lead_time:i n:i", CL("SELECT lead_time, count(*) AS n FROM cleaned GROUP BY 1"))(
    lambda s, d: X.permute_column(frame_cleaned(s, d), "lead_time").groupBy("lead_time").agg(F.count(F.lit(1)).alias("n")))

# --- Projection ----------------------------------------------------------------------------------------


def _plane(s, d):
    tr = _prepared(s, d)[3].select("booking_id", "label", F.col("features").alias("v"))
    return tr, *PR.orient(tr, PR.fit_pls(tr, "v", "label"), "v", "label")


@query("pls_fit", "position:i feature:s r1:d r2:d")
def pls_fit(s, d):
    _, pls, _ = _plane(s, d)
    return s.createDataFrame([(i, n, float(a), float(b)) for i, (n, (a, b)) in enumerate(zip(_names(s, d), pls.rotations))], "position int, feature string, r1 double, r2 double")


_CORR = ", ".join(f"coalesce(CASE WHEN isfinite(c_{c}) THEN c_{c} END, 0) AS c_{c}" for c in S.NUMERIC)
@query("pls_first_axis", "feature:s weight:d", CL(", t AS (SELECT " + ", ".join(f"corr(CAST(coalesce({c}, 0) AS DOUBLE), CAST(is_canceled AS DOUBLE)) AS c_{c}" for c in S.NUMERIC) + f""" FROM cleaned),
u AS (SELECT {_CORR} FROM t), n AS (SELECT sqrt({" + ".join(f"c_{c} * c_{c}" for c in S.NUMERIC)}) AS n FROM u) """
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, c_{c} / n AS weight FROM u, n" for c in S.NUMERIC)))
def pls_first_axis(s, d):
    """First PLS direction over the raw numeric columns: it is the normalised vector of correlations with the target."""
    df = frame_cleaned(s, d).select(F.col(S.TARGET).cast("double").alias("y"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in S.NUMERIC]).alias("v"))
    pls, _ = PR.orient(df, PR.fit_pls(df, "v", "y"), "v", "y")
    return s.createDataFrame([(c, float(w)) for c, w in zip(S.NUMERIC, pls.rotations[:, 0])], "feature string, weight double")


@query("pls_orient", "label:d mean_c1:d mean_c2:d n:i")
def pls_orient(s, d):
    tr, pls, _ = _plane(s, d)
    return PR.project(tr, pls, "v").groupBy("label").agg(F.avg("c1").alias("mean_c1"), F.avg("c2").alias("mean_c2"), F.count(F.lit(1)).alias("n"))


_LIM = """, lim AS (SELECT quantile_cont(CAST(lead_time AS DOUBLE), 0.01) AS x0, quantile_cont(CAST(lead_time AS DOUBLE), 0.99) AS x1, quantile_cont(adr, 0.01) AS y0, quantile_cont(adr, 0.99) AS y1 FROM cleaned)"""


def _limits(s, d):
    return PR.plane_limits(frame_cleaned(s, d), "lead_time", "adr")


query("plane_limits", "axis:s low:d high:d", CL(f"{_LIM} SELECT 'lead_time' AS axis, x0 AS low, x1 AS high FROM lim UNION ALL SELECT 'adr', y0, y1 FROM lim"))(_limits)
query("grid_points", "gx:i gy:i lead_time:d adr:d", CL(f"""{_LIM}
SELECT a.i AS gx, b.i AS gy, x0 + a.i * ((x1 - x0) / 299) AS lead_time, y0 + b.i * ((y1 - y0) / 299) AS adr FROM lim, range(300) a(i), range(300) b(i)"""))(
    lambda s, d: PR.grid_points(_limits(s, d), "lead_time", "adr"))
query("scatter_sample", "booking_id:i lead_time:i adr:d is_canceled:i", CL(f"""{_LIM}
SELECT c.* FROM cleaned c, lim WHERE lead_time BETWEEN x0 AND x1 AND adr BETWEEN y0 AND y1
ORDER BY {_ORDER}, booking_id LIMIT 1500"""))(
    lambda s, d: PR.scatter_sample(frame_cleaned(s, d), limits=_limits(s, d)))


@query("decision_grid", "model:s gx:i gy:i p:d")
def decision_grid(s, d):
    train, test, *_ = _prepared(s, d)
    return JB.map_job(train, test)["grid"]


query("project_bookings", "booking_id:i c1:d c2:d")(lambda s, d: JB.project_bookings(_prepared(s, d)[2], _plane(s, d)[1], _prepared(s, d)[1]))


@query("map_roundtrip", "booking_id:i same:b", with_frames("split", "SELECT booking_id, TRUE AS same FROM split WHERE split = 'test'"))
def map_roundtrip(s, d):
    """Test bookings placed by a saved and reloaded plane, against the fitted one; limits and a scored grid as well."""
    _, test, pre, tr, *_ = _prepared(s, d)
    plane, folder = PL.PlaneProjector().fit(tr), scratch_path(s, "map")
    model = {"Logistic Regression": M.logistic(tr.count())}
    models = PR.fit_on_plane(model, materialise(plane.transform(tr).select("booking_id", "label", "c1", "c2"), "plane"))
    limits = plane.limits_table(s)
    PL.save_map(folder, pre, plane, models, PR.decision_grid(models, PR.grid_points(limits)))
    stored = PL.StoredMap(s, folder)
    whole = stored.plane.limits_table(s).exceptAll(limits).isEmpty() and stored.score_grid(S.GRID_SIDE).exceptAll(stored.grid()).isEmpty()
    fresh = plane.transform(pre.transform(test)).select("booking_id", F.col("c1").alias("f1"), F.col("c2").alias("f2"))
    same = (F.col("c1") == F.col("f1")) & (F.col("c2") == F.col("f2")) & F.lit(whole)
    return stored.place(test, "booking_id").join(fresh, "booking_id").select("booking_id", same.alias("same"))


query("surface_two_features", "gx:i gy:i lead_time:d adr:d p:d")(lambda s, d: PR.surface_two_features(_pipeline(s, d), _prepared(s, d)[0], "lead_time", "adr"))

# --- Scoring and whole jobs ---------------------------------------------------------------------------------

query("score_batch", _SCORE_SPEC)(lambda s, d: SC.score_batch(_pipeline(s, d), bookings(s, d)))


@query("score_sink", _SCORE_SPEC)
def score_sink(s, d):
    path = ST.write_predictions(SC.score_batch(_pipeline(s, d), bookings(s, d)), scratch_path(s, "predictions"), fmt="parquet")
    return s.read.parquet(path)


@query("score_job", _SCORE_SPEC)
def score_job(s, d):
    """All raw bookings as a CSV file in, a CSV of predictions out."""
    raw = write_csv(bookings(s, d), scratch_path(s, "raw"))
    return JB.score_job(s, _pipeline(s, d), scratch_path(s, "scored"), csv=raw)


@query("model_roundtrip", "rows:i same:i", B("SELECT count(*) AS rows, count(*) AS same FROM bookings"))
def model_roundtrip(s, d):
    folder, model = scratch_path(s, "models"), _pipeline(s, d)
    ST.save_models({"Decision Tree": model}, folder)
    again = ST.load_model(folder, "Decision Tree")
    a = SC.score_batch(model, bookings(s, d)).withColumnRenamed("probability_canceled", "p")
    b = SC.score_batch(again, bookings(s, d)).select("booking_id", F.col("probability_canceled").alias("q"))
    return a.join(b, "booking_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p") == F.col("q")).alias("same"))


def _stream_rows(s, d):
    """Bookings, some with a broken week or lead time."""
    rows = bookings(s, d).select("booking_id", *S.FEATURES)
    rows = rows.withColumns({c: F.coalesce(c, F.lit("Desconocido")) for c in ("country", "agent")} | {"company": F.coalesce("company", F.lit("no_company"))})
    return rows.withColumns({
        "arrival_date_week_number": F.when(F.col("lead_time") % 37 == 0, 99).otherwise(F.col("arrival_date_week_number")),
        "lead_time": F.when(F.col("lead_time") % 41 == 0, -5).otherwise(F.col("lead_time"))})


def _stream(s, d):
    """The rows as JSON lines through the stream; folders of the scored and the held rows."""
    source, out, bad, mark = (scratch_path(s, n) for n in ("stream_in", "stream_out", "stream_bad", "stream_mark"))
    _stream_rows(s, d).write.json(source)
    STREAM.score_stream(STREAM.booking_stream(s, source), _pipeline(s, d), out, bad, mark).awaitTermination()
    return out, bad


query("score_stream", "booking_id:i prediction:i probability_canceled:d label:s")(lambda s, d: s.read.parquet(_stream(s, d)[0]))
_BAD_CODES = "concat_ws(',', CASE WHEN children IS NULL THEN 'missing:children' END, CASE WHEN lead_time % 41 = 0 THEN 'range:lead_time' END, CASE WHEN lead_time % 37 = 0 THEN 'range:arrival_date_week_number' END)"
query("stream_quarantine", "booking_id:i violations:s", B(f"SELECT booking_id, {_BAD_CODES} AS violations FROM bookings WHERE {_BAD_CODES} <> ''"))(
    lambda s, d: s.read.parquet(_stream(s, d)[1]).select("booking_id", F.concat_ws(",", "violations").alias("violations")))
query("stream_scored_keys", "booking_id:i known_label:b", B(f"SELECT booking_id, true AS known_label FROM bookings WHERE {_BAD_CODES} = ''"))(
    lambda s, d: s.read.parquet(_stream(s, d)[0]).select("booking_id", F.col("label").isin(S.CLASS_LABELS).alias("known_label")))


@query("stream_equals_batch", "booking_id:i same:b", B(f"SELECT booking_id, true AS same FROM bookings WHERE {_BAD_CODES} = ''"))
def stream_equals_batch(s, d):
    """Every streamed prediction against the batch one of the same row."""
    batch = SC.score_batch(_pipeline(s, d), _stream_rows(s, d)).select("booking_id", F.col("prediction").alias("b"), F.col("probability_canceled").alias("q"))
    same = (F.col("prediction") == F.col("b")) & (F.col("probability_canceled") == F.col("q"))
    return s.read.parquet(_stream(s, d)[0]).join(batch, "booking_id").select("booking_id", same.alias("same"))


@query("score_same", "booking_id:i sink:b job:b", B("SELECT booking_id, true AS sink, true AS job FROM bookings"))
def score_same(s, d):
    """Predictions read back from the parquet sink and from the CSV-to-CSV job, against the batch ones."""
    out = SC.score_batch(_pipeline(s, d), bookings(s, d)).select("booking_id", F.struct("prediction", "probability_canceled").alias("batch"))
    for name, other in (("sink", score_sink(s, d)), ("job", score_job(s, d))):
        out = out.join(other.select("booking_id", F.struct("prediction", "probability_canceled").alias(name)), "booking_id")
    return out.select("booking_id", *[(F.col(n) == F.col("batch")).alias(n) for n in ("sink", "job")])


query("train_job", _METRIC_SPEC)(
    lambda s, d: JB.train_job(bookings(s, d), scratch_path(s, "job"))["metrics"])
