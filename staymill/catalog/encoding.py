"""Sources, derived features, encoders and splits."""

from __future__ import annotations

from staymill.catalog.base import ABSENT_SQL, F, S, bookings, frame_cleaned, frame_split, mix_sql, query, table, with_frames
from staymill.functions.session import scratch_path
from staymill.functions.vectors import width_and_filled
from staymill.operators import encode as E
from staymill.operators import features as FT
from staymill.operators import split as SP
from staymill.sources import csv as IO

B = lambda body: with_frames("bookings", body)
CL = lambda body: with_frames("cleaned", body)
SPL = lambda body: with_frames("split", body)

# --- Sources and sinks ------------------------------------------------------------

NA_SPEC = "booking_id:i lead_time:i children:d country:s agent:s company:s adr:d is_canceled:i"


@query("load_na_tokens", NA_SPEC, B("SELECT booking_id, lead_time, children, country, agent, company, adr, is_canceled FROM bookings"))
def load_na_tokens(spark, d):
    """Nulls are written as different tokens per column; all of them must come back as null."""
    df = bookings(spark, d).select("booking_id", "lead_time", "children", "country", "agent", "company", "adr", "is_canceled")
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).withColumns({
        "children": F.coalesce("children", F.lit("NaN")),
        "country": F.coalesce("country", F.lit("NA")),
        "agent": F.coalesce(F.concat("agent", F.lit(".0")), F.lit("NULL")),
        "company": F.coalesce("company", F.lit("")),
    })
    back = IO.load_raw(spark, IO.write_csv(text, scratch_path(spark, "raw_csv")))
    return back.withColumn("agent", F.regexp_replace("agent", r"\.0$", ""))


@query("prepared_split_counts", "split:s is_canceled:i n:i", SPL("SELECT split, is_canceled, count(*) AS n FROM split GROUP BY 1, 2"))
def prepared_split_counts(spark, d):
    path = IO.write_prepared(frame_split(spark, d), scratch_path(spark, "prepared"))
    return IO.read_prepared(spark, path).groupBy("split", "is_canceled").agg(F.count(F.lit(1)).alias("n"))


# --- Derived features ---------------------------------------------------------------

_ABS = lambda c: f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN {ABSENT_SQL} THEN 0 ELSE 1 END"


def _worded(s, d):
    """Bookings whose absent identifiers are partly written as words, with stray blanks."""
    df = bookings(s, d)
    return df.withColumns({
        "company": F.when(F.col("company").isNull() & (F.col("lead_time") % 2 == 0), " No_Company ").otherwise(F.col("company")),
        "agent": F.when(F.col("lead_time") % 11 == 0, F.concat(F.lit(" "), "agent")).when(F.col("lead_time") % 13 == 0, "Desconocido").otherwise(F.col("agent")),
        "country": F.when(F.col("lead_time") % 17 == 0, "unknown").otherwise(F.col("country")),
    })


_WORDED_SQL = """, worded AS (SELECT * REPLACE (
  CASE WHEN company IS NULL AND lead_time % 2 = 0 THEN ' No_Company ' ELSE company END AS company,
  CASE WHEN lead_time % 11 = 0 THEN ' ' || agent WHEN lead_time % 13 = 0 THEN 'Desconocido' ELSE agent END AS agent,
  CASE WHEN lead_time % 17 = 0 THEN 'unknown' ELSE country END AS country) FROM bookings)"""
_KEY = lambda c: f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN {ABSENT_SQL} THEN NULL ELSE trim({c}) END"

query("feat_nights", "booking_id:i noches:i", B("SELECT booking_id, coalesce(stays_in_week_nights, 0) + coalesce(stays_in_weekend_nights, 0) AS noches FROM bookings"))(
    lambda s, d: bookings(s, d).select("booking_id", FT.nights().alias("noches")))
query("feat_absence", "booking_id:i has_company:i has_agent:i", B(f"{_WORDED_SQL} SELECT booking_id, {_ABS('company')} AS has_company, {_ABS('agent')} AS has_agent FROM worded"))(
    lambda s, d: (lambda df: df.select("booking_id", FT.presence(df, "company").alias("has_company"), FT.presence(df, "agent").alias("has_agent")))(_worded(s, d)))


@query("feat_id_keys", "booking_id:i agent:s agent_text:s company:s country:s", B(f"""{_WORDED_SQL}
SELECT w.booking_id, b.agent, {_KEY('w.agent')} AS agent_text, {_KEY('w.company')} AS company, {_KEY('w.country')} AS country
FROM worded w JOIN bookings b ON b.booking_id = w.booking_id"""))
def feat_id_keys(s, d):
    """The numeric agent (9.0) and the text agent give the same kind of key."""
    from staymill.functions.absence import id_key
    from pyspark.sql import types as T

    df = _worded(s, d)
    df = df.join(bookings(s, d).select("booking_id", F.col("agent").cast("double").alias("agent_number")), "booking_id")
    return df.select(
        "booking_id", id_key(F.col("agent_number"), T.DoubleType()).alias("agent"), id_key(F.col("agent"), T.StringType()).alias("agent_text"),
        id_key(F.col("company"), T.StringType()).alias("company"), id_key(F.col("country"), T.StringType()).alias("country"))


query("feature_builder", "booking_id:i children:i noches:i has_company:i has_agent:i agent:s country:s company:s", B(f"""{_WORDED_SQL}
SELECT booking_id, coalesce(children, 0) AS children, coalesce(stays_in_week_nights, 0) + coalesce(stays_in_weekend_nights, 0) AS noches,
  {_ABS('company')} AS has_company, {_ABS('agent')} AS has_agent, {_KEY('agent')} AS agent, {_KEY('country')} AS country, {_KEY('company')} AS company FROM worded"""))(
    lambda s, d: FT.FeatureBuilder().transform(_worded(s, d)))

# --- Category reduction --------------------------------------------------------------

_LONG = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS value, is_canceled AS y, split FROM split" for c in S.RARE_COLUMNS)


def _stats_sql(name: str, where: str) -> str:
    return f"""{name}_s AS (SELECT variable, value, avg(y) AS rate, count(*) AS n FROM long WHERE value IS NOT NULL AND {where} GROUP BY 1, 2),
{name}_t AS (SELECT variable, max(rate) AS top FROM {name}_s WHERE n >= 100 GROUP BY 1),
{name} AS (SELECT s.*, coalesce(n >= 100 AND (rate > CAST(0.6 AS DOUBLE) * top OR rate < CAST(0.3 AS DOUBLE) * top), false) AS keep
  FROM {name}_s s LEFT JOIN {name}_t t ON s.variable = t.variable)"""


def _train(s, d):
    return FT.build_features(frame_split(s, d))


query("rare_fit", "variable:s value:s rate:d n:i keep:b", SPL(f", long AS ({_LONG}), {_stats_sql('st', 'split = $$train$$')} SELECT * FROM st"))(
    lambda s, d: FT.rare_stats(_train(s, d).where("split = 'train'"), S.RARE_COLUMNS))
_RED = lambda c, label: f"CASE WHEN {c} IS NULL THEN '{label}' WHEN {c} IN (SELECT value FROM st WHERE keep AND variable = '{c}') THEN {c} ELSE 'Otros' END AS {c}"
_REDUCED = f", long AS ({_LONG}), {_stats_sql('st', 'split = $$train$$')}, reduced AS (SELECT * REPLACE ({', '.join(_RED(c, S.RARE_NULL_LABELS[c]) for c in S.RARE_COLUMNS)}) FROM split)"


@query("rare_transform", "booking_id:i agent:s country:s company:s", SPL(f"{_REDUCED} SELECT * FROM reduced"))
def rare_transform(s, d):
    df = _train(s, d)
    return FT.RareCategoryGrouper().fit(df.where("split = 'train'")).transform(df)


query("rare_fit_unsup", "variable:s value:s", SPL(f", long AS ({_LONG}) SELECT DISTINCT variable, value FROM long WHERE value IS NOT NULL"))(
    lambda s, d: FT.seen_values(_train(s, d), S.RARE_COLUMNS))
query("rare_leak_diff", "variable:s kept_train:i kept_full:i only_full:i only_train:i", SPL(f""", long AS ({_LONG}), {_stats_sql('st', 'split = $$train$$')}, {_stats_sql('fu', 'true')},
both_sides AS (SELECT coalesce(a.variable, b.variable) AS variable, a.value AS t, b.value AS f FROM (SELECT * FROM st WHERE keep) a FULL JOIN (SELECT * FROM fu WHERE keep) b
  ON a.variable = b.variable AND a.value = b.value)
SELECT variable, count(t) AS kept_train, count(f) AS kept_full, count(*) FILTER (WHERE t IS NULL) AS only_full, count(*) FILTER (WHERE f IS NULL) AS only_train FROM both_sides GROUP BY 1"""))(
    lambda s, d: (lambda f: FT.rare_leak_diff(f.where("split = 'train'"), f))(_train(s, d)))


@query("cardinality", "variable:s before:i after:i", SPL(f"{_REDUCED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, (SELECT count(DISTINCT {c}) FROM split) AS before, (SELECT count(DISTINCT {c}) FROM reduced) AS after" for c in S.RARE_COLUMNS)))
def cardinality(s, d):
    from staymill.operators.profile import cardinality as count_values

    df = _train(s, d)
    reduced = FT.RareCategoryGrouper().fit(df.where("split = 'train'")).transform(df)
    after = count_values(reduced, S.RARE_COLUMNS).select(F.col("variable").alias("_v"), F.col("n").alias("after"))
    return count_values(df, S.RARE_COLUMNS).join(after, F.col("variable") == F.col("_v")).select("variable", F.col("n").alias("before"), "after")


# --- Imputation and scaling, fitted on train ------------------------------------------

_NUM = ["lead_time", "adr", "children", "babies"]
_NUM_SPEC = "booking_id:i " + " ".join(f"{c}:d" for c in _NUM)
_HOLED_SQL = ", holed AS (SELECT * REPLACE (CASE WHEN lead_time % 50 <> 0 THEN adr END AS adr) FROM split)"


def _holed(s, d):
    """Split rows with gaps in the rate; `children` has its own."""
    return frame_split(s, d).withColumn("adr", F.when(F.col("lead_time") % 50 != 0, F.col("adr")))


def _fitted(s, d, estimator):
    df = _holed(s, d)
    return estimator.fit(df.where("split = 'train'")).transform(df)


def _fill_sql(fn: str) -> str:
    return SPL(_HOLED_SQL + " SELECT booking_id, " + ", ".join(f"coalesce({c}, (SELECT {fn.format(c)} FROM holed WHERE split = 'train')) AS {c}" for c in _NUM) + " FROM holed")


query("impute_median", _NUM_SPEC, _fill_sql("quantile_cont(CAST({0} AS DOUBLE), 0.5)"))(lambda s, d: _fitted(s, d, E.MedianImputer(columns=_NUM)))
query("impute_mean", _NUM_SPEC, _fill_sql("avg({0})"))(lambda s, d: _fitted(s, d, E.MeanImputer(columns=_NUM)))
query("impute_unknown", "booking_id:i country:s agent:s company:s", CL("""
SELECT booking_id, coalesce(country, 'Unknown') AS country, coalesce(agent, 'Unknown') AS agent, coalesce(company, 'Unknown') AS company FROM cleaned"""))(
    lambda s, d: E.ConstantImputer().transform(frame_cleaned(s, d)))
_CONST = [*_NUM, "one"]
_SC_SPEC = "booking_id:i " + " ".join(f"{c}:d" for c in _CONST)


def _scaled(s, d, estimator):
    df = frame_split(s, d).withColumn("one", F.lit(1.0))
    return estimator.fit(df.where("split = 'train'")).transform(df)


def _scale_sql(shift: str, width: str) -> str:
    return SPL(", c AS (SELECT *, CAST(1 AS DOUBLE) AS one FROM split), f AS (SELECT " + ", ".join(f"{shift.format(c)} AS a_{c}, coalesce(nullif({width.format(c)}, 0), 1) AS b_{c}" for c in _CONST)
               + " FROM c WHERE split = 'train') SELECT booking_id, " + ", ".join(f"({c} - a_{c}) / b_{c} AS {c}" for c in _CONST) + " FROM c, f")


query("scale_standard", _SC_SPEC, _scale_sql("avg({0})", "stddev_pop({0})"))(lambda s, d: _scaled(s, d, E.StandardScaler(columns=_CONST)))
query("scale_minmax", _SC_SPEC, _scale_sql("min({0})", "CAST(max({0}) - min({0}) AS DOUBLE)"))(lambda s, d: _scaled(s, d, E.MinMaxScaler(columns=_CONST)))

# --- Encoders -------------------------------------------------------------------------

_HOT = ["hotel", "meal", "deposit_type", "agent"]
query("onehot_long", "booking_id:i feature:s value:i", SPL(" UNION ALL ".join(
    f"SELECT booking_id, '{c}_' || {c} AS feature, 1 AS value FROM split WHERE {c} IN (SELECT {c} FROM split WHERE split = 'train')" for c in _HOT)))(
    lambda s, d: (lambda f: E.onehot_long(f, f.where("split = 'train'"), _HOT))(_train(s, d)))
_ROOMS = ["A", "B", "D", "E"]
query("dummies_reindex", "booking_id:i " + " ".join(f"assigned_room_type_{r}:i" for r in _ROOMS), B(
    "SELECT booking_id, " + ", ".join(f"CAST(assigned_room_type = '{r}' AS INT) AS assigned_room_type_{r}" for r in _ROOMS) + " FROM bookings"))(
    lambda s, d: (lambda b: E.dummies(b, "assigned_room_type", E.levels(b, "reserved_room_type")))(bookings(s, d)))
query("onehot_drop_first", "booking_id:i meal_FB:i meal_HB:i meal_SC:i", B("SELECT booking_id, " + ", ".join(
    f"CAST(meal = '{m}' AS INT) AS meal_{m}" for m in ("FB", "HB", "SC")) + " FROM bookings"))(
    lambda s, d: (lambda b: E.dummies(b, "meal", E.levels(b, "meal"), drop_first=True))(bookings(s, d)))
query("ordinal_codes", "booking_id:i market_segment_code:i", B(
    "SELECT booking_id, dense_rank() OVER (ORDER BY market_segment) - 1 AS market_segment_code FROM bookings"))(
    lambda s, d: (lambda b: E.ordinal_codes(b, "market_segment", E.levels(b, "market_segment")))(bookings(s, d)))
query("poly_features", "l_quantity:d l_discount:d l_quantity_2:d l_quantity__l_discount:d l_discount_2:d", """
SELECT l_quantity, l_discount, l_quantity * l_quantity AS l_quantity_2, l_quantity * l_discount AS l_quantity__l_discount, l_discount * l_discount AS l_discount_2 FROM lineitem""")(
    lambda s, d: E.poly_features(table(s, d, "lineitem").select("l_quantity", "l_discount"), ["l_quantity", "l_discount"], 2))


@query("feature_names", "position:i feature:s", SPL(f"""{_REDUCED},
named AS ({" UNION ALL ".join(f"SELECT {i} AS block, '{c}' AS feature" for i, c in enumerate(S.MODEL_NUMERIC))}
  UNION ALL {" UNION ALL ".join(f"SELECT DISTINCT {100 + i}, '{c}_' || coalesce({c}, 'Unknown') FROM reduced WHERE split = 'train'" for i, c in enumerate(S.CATEGORICAL))})
SELECT row_number() OVER (ORDER BY block, feature) - 1 AS position, feature FROM named"""))
def feature_names(s, d):
    train = frame_split(s, d).where("split = 'train'")
    out = E.preprocessor().fit(train).transform(train)
    return s.createDataFrame(list(enumerate(E.feature_names(out))), "position int, feature string")


_Z = {c: c if c in S.NUMERIC and c != "children" else "coalesce(children, 0)" if c == "children" else
      "coalesce(stays_in_week_nights, 0) + coalesce(stays_in_weekend_nights, 0)" if c == "noches" else f"CASE WHEN {c[4:]} IS NULL THEN 0 ELSE 1 END" for c in S.MODEL_NUMERIC}


@query("preprocess_transform", "booking_id:i is_canceled:i width:i total:d", SPL(f"""{_REDUCED},
hot AS (SELECT booking_id AS rid, {", ".join(f"coalesce({c}, 'Unknown') AS t_{c}" for c in S.CATEGORICAL)} FROM reduced),
z AS (SELECT booking_id, is_canceled, split, {", ".join(f"CAST({e} AS DOUBLE) AS z_{c}" for c, e in _Z.items())}, hot.* FROM split JOIN hot ON booking_id = rid),
f AS (SELECT {", ".join(f"median(z_{c}) AS q_{c}, avg(z_{c}) AS m_{c}, coalesce(nullif(stddev_pop(z_{c}), 0), 1) AS s_{c}" for c in _Z)},
  {len(_Z)} + {" + ".join(f"count(DISTINCT t_{c})" for c in S.CATEGORICAL)} AS width FROM z WHERE split = 'train')
SELECT booking_id, is_canceled, width, {" + ".join(f"(coalesce(z_{c}, q_{c}) - m_{c}) / s_{c}" for c in _Z)}
  + {" + ".join(f"CASE WHEN t_{c} IN (SELECT t_{c} FROM z WHERE split = 'train') THEN 1 ELSE 0 END" for c in S.CATEGORICAL)} AS total FROM z, f"""))
def preprocess_transform(s, d):
    """Model matrix of all rows: vector width and the sum of the entries of each row."""
    df = frame_split(s, d)
    model = E.preprocessor().fit(df.where("split = 'train'"))
    width, filled = width_and_filled(E.FEATURES_COL)
    return E.transform_features(model, df, ["booking_id", "is_canceled"]).select(
        "booking_id", "is_canceled", width.alias("width"), F.aggregate(filled, F.lit(0.0), lambda a, x: a + x).alias("total"))


# --- Splits and weights ------------------------------------------------------------------

query("split_stratified", "booking_id:i is_canceled:i split:s", SPL("SELECT * FROM split"))(frame_split)
query("split_random", "booking_id:i split:s", CL(f"SELECT booking_id, CASE WHEN {mix_sql('booking_id', 42)} < 429496729 THEN 'test' ELSE 'train' END AS split FROM cleaned"))(
    lambda s, d: SP.split_random(frame_cleaned(s, d)))
query("load_and_prepare", "booking_id:i is_canceled:i lead_time:i adr:d agent:s split:s", SPL("SELECT * FROM split"))(frame_split)
query("fold_assign", "booking_id:i is_canceled:i fold:i", CL(f"""
SELECT booking_id, is_canceled, (row_number() OVER (PARTITION BY is_canceled ORDER BY {mix_sql('booking_id', 42)}, booking_id) - 1) % 5 AS fold FROM cleaned"""))(
    lambda s, d: SP.fold_assign(frame_cleaned(s, d), 5))
query("split_class_ratio", "split:s is_canceled:i n:i share:d", SPL("""
SELECT split, is_canceled, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY split) AS share FROM split GROUP BY 1, 2"""))(
    lambda s, d: SP.split_class_ratio(frame_split(s, d)))
query("class_weights", "is_canceled:i n:i weight:d", CL("""
SELECT is_canceled, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight FROM cleaned GROUP BY 1"""))(
    lambda s, d: SP.class_weights(frame_cleaned(s, d)))
query("pos_weight", "negatives:i positives:i scale_pos_weight:d", CL("""
SELECT count(*) FILTER (WHERE is_canceled = 0) AS negatives, count(*) FILTER (WHERE is_canceled = 1) AS positives,
  CAST(count(*) FILTER (WHERE is_canceled = 0) AS DOUBLE) / count(*) FILTER (WHERE is_canceled = 1) AS scale_pos_weight FROM cleaned"""))(
    lambda s, d: SP.pos_weight(frame_cleaned(s, d)))


@query("dup_leak_share", "test_rows:i copied:i copied_share:d", f"""
WITH s AS (SELECT *, CASE WHEN {mix_sql('doc_id', 42)} < 429496729 THEN 'test' ELSE 'train' END AS split FROM documents),
t AS (SELECT text, lang, source, EXISTS (SELECT 1 FROM s b WHERE b.split = 'train' AND b.text IS NOT DISTINCT FROM a.text AND b.lang IS NOT DISTINCT FROM a.lang
  AND b.source IS NOT DISTINCT FROM a.source) AS hit FROM s a WHERE a.split = 'test')
SELECT count(*) AS test_rows, count(*) FILTER (WHERE hit) AS copied, count(*) FILTER (WHERE hit) / count(*) AS copied_share FROM t""")
def dup_leak_share(s, d):
    docs = SP.split_random(table(s, d, "documents"), key="doc_id")
    return SP.dup_leak_share(docs.where("split = 'test'"), docs.where("split = 'train'"), ["text", "lang", "source"])
