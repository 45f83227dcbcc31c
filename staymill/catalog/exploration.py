"""Cleaning and profiling queries."""

from __future__ import annotations

from staymill.catalog.base import ABSENT_SQL, F, KEEP_SQL, S, bookings, frame_cleaned, frame_split, query, table, with_frames
from staymill.operators import clean as C
from staymill.operators import profile as P
from staymill.operators import split as SP

RAW_SPEC = (
    "booking_id:i hotel:s is_canceled:i lead_time:i arrival_date_month:s arrival_date_week_number:i arrival_date_day_of_month:i "
    "stays_in_weekend_nights:i stays_in_week_nights:i adults:i children:d babies:i meal:s country:s market_segment:s distribution_channel:s "
    "is_repeated_guest:i previous_cancellations:i previous_bookings_not_canceled:i reserved_room_type:s booking_changes:i deposit_type:s "
    "agent:s company:s days_in_waiting_list:i customer_type:s adr:d total_of_special_requests:i"
)
FEATURE_SPEC = RAW_SPEC.replace("is_canceled:i ", "")
EXTRA_SPEC = " arrival_date_year:i assigned_room_type:s required_car_parking_spaces:i reservation_status:s reservation_status_date:s"
B = lambda body: with_frames("bookings", body)
CL = lambda body: with_frames("cleaned", body)


# --- Cleaning -------------------------------------------------------------------

query("drop_leakage", RAW_SPEC, B("SELECT * FROM bookings"))(lambda s, d: C.drop_leakage(bookings(s, d)))
query("filter_guests", RAW_SPEC, B("SELECT * FROM bookings WHERE coalesce(adults,0) + coalesce(children,0) + coalesce(babies,0) > 0"))(
    lambda s, d: C.filter_guests(bookings(s, d)))
query("filter_nights", RAW_SPEC, B("SELECT * FROM bookings WHERE coalesce(stays_in_week_nights,0) + coalesce(stays_in_weekend_nights,0) > 0"))(
    lambda s, d: C.filter_nights(bookings(s, d)))


def _with_null_adr(s, d):
    df = bookings(s, d)
    return df.withColumn("adr", F.when(F.col("lead_time") % 50 != 0, F.col("adr")))


query("filter_adr", RAW_SPEC, B("""
, holed AS (SELECT * REPLACE (CASE WHEN lead_time % 50 <> 0 THEN adr END AS adr) FROM bookings)
SELECT * FROM holed WHERE adr IS NULL OR (adr >= 0 AND adr < 5400)"""))(lambda s, d: C.filter_adr(_with_null_adr(s, d)))
query("clean_bookings", RAW_SPEC, CL("SELECT * FROM cleaned"))(frame_cleaned)
query("clean_audit", "no_guests:i no_nights:i bad_adr:i removed:i removed_share:d left:i", B(f"""
SELECT count(*) FILTER (WHERE NOT coalesce(adults,0) + coalesce(children,0) + coalesce(babies,0) > 0) AS no_guests,
  count(*) FILTER (WHERE NOT coalesce(stays_in_week_nights,0) + coalesce(stays_in_weekend_nights,0) > 0) AS no_nights,
  count(*) FILTER (WHERE adr < 0 OR adr >= 5400) AS bad_adr,
  count(*) FILTER (WHERE NOT ({KEEP_SQL})) AS removed,
  count(*) FILTER (WHERE NOT ({KEEP_SQL})) / count(*) AS removed_share,
  count(*) FILTER (WHERE {KEEP_SQL}) AS "left" FROM bookings"""))(lambda s, d: C.clean_audit(bookings(s, d)))
query("feature_target", RAW_SPEC, CL("SELECT * FROM cleaned"))(lambda s, d: C.feature_target(frame_cleaned(s, d)))
query("inference_prep", FEATURE_SPEC + EXTRA_SPEC, B("SELECT * EXCLUDE (is_canceled) FROM bookings"))(lambda s, d: C.inference_prep(bookings(s, d)))


def _odd_names(df):
    return df.select(F.col("l_orderkey").alias("Order Key"), F.col("l_quantity").alias("Quantity (pcs)"), F.col("l_extendedprice").alias("Extended  Price [EUR]"))


query("normalise_names", "order_key:i quantity:d extended_price:d", "SELECT l_orderkey AS order_key, l_quantity AS quantity, l_extendedprice AS extended_price FROM lineitem")(
    lambda s, d: C.normalise_names(_odd_names(table(s, d, "lineitem"))))
query("dropna_any", "booking_id:i children:d country:s agent:s company:s", B("""
SELECT booking_id, children, country, agent, company FROM bookings
WHERE children IS NOT NULL AND country IS NOT NULL AND agent IS NOT NULL AND company IS NOT NULL"""))(
    lambda s, d: C.drop_nulls(bookings(s, d).select("booking_id", "children", "country", "agent", "company")))
query("dropna_subset", "booking_id:i children:d country:s agent:s company:s", B("SELECT * FROM bookings WHERE agent IS NOT NULL AND country IS NOT NULL"))(
    lambda s, d: C.drop_nulls(bookings(s, d), ["agent", "country"]))
query("cast_map", "booking_id:i lead_time:d adr:i is_canceled:s parked:i", B("""
SELECT booking_id, CAST(lead_time AS DOUBLE) AS lead_time, CAST(trunc(adr) AS INT) AS adr, CAST(is_canceled AS VARCHAR) AS is_canceled,
  CAST(required_car_parking_spaces > 0 AS INT) AS parked FROM bookings"""))(
    lambda s, d: C.cast_columns(
        bookings(s, d).withColumn("parked", F.col("required_car_parking_spaces") > 0),
        {"lead_time": "double", "adr": "int", "is_canceled": "string", "parked": "int"}))
_NUMBERS = " ".join(x for x in (RAW_SPEC + EXTRA_SPEC).split() if x[-1] in "id")
query("select_kinds", _NUMBERS, B("SELECT " + ", ".join(x.split(":")[0] for x in _NUMBERS.split()) + " FROM bookings"))(
    lambda s, d: C.select_kinds(bookings(s, d), "number"))
query("replace_values", "booking_id:i meal:s deposit_type:s", B("""
SELECT booking_id, CASE meal WHEN 'SC' THEN 'Self catering' WHEN 'BB' THEN 'Breakfast' ELSE meal END AS meal, deposit_type FROM bookings"""))(
    lambda s, d: C.replace_values(bookings(s, d), {"SC": "Self catering", "BB": "Breakfast"}, ["meal"]))
query("fill_const", "booking_id:i children:d country:s", B("SELECT booking_id, coalesce(children, 0) AS children, coalesce(country, 'none') AS country FROM bookings"))(
    lambda s, d: C.fill_nulls(bookings(s, d), {"children": 0.0, "country": "none"}))

_CODES = [f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END" for c in S.FEATURES]
for _c, _lo, _hi in S.RANGES:
    _bad = " OR ".join([f"{_c} < {_lo}"] * (_lo is not None) + [f"{_c} > {_hi}"] * (_hi is not None))
    if _bad:
        _CODES.append(f"CASE WHEN {_bad} THEN 'range:{_c}' END")


def _broken(s, d):
    """Bookings with planted range errors in week, day and lead time."""
    return bookings(s, d).withColumns({
        "arrival_date_week_number": F.when(F.col("lead_time") % 37 == 0, 99).otherwise(F.col("arrival_date_week_number")),
        "arrival_date_day_of_month": F.when(F.col("lead_time") % 41 == 0, 0).otherwise(F.col("arrival_date_day_of_month")),
        "lead_time": F.when(F.col("lead_time") % 43 == 0, -5).otherwise(F.col("lead_time")),
    })


_BROKEN_SQL = """, broken AS (SELECT * REPLACE (
  CASE WHEN lead_time % 37 = 0 THEN 99 ELSE arrival_date_week_number END AS arrival_date_week_number,
  CASE WHEN lead_time % 41 = 0 THEN 0 ELSE arrival_date_day_of_month END AS arrival_date_day_of_month,
  CASE WHEN lead_time % 43 = 0 THEN -5 ELSE lead_time END AS lead_time) FROM bookings)"""
query("validate_contract", "booking_id:i codes:s valid:b", B(f"""{_BROKEN_SQL}
SELECT booking_id, concat_ws(',', {', '.join(_CODES)}) AS codes, concat_ws(',', {', '.join(_CODES)}) = '' AS valid FROM broken"""))(
    lambda s, d: C.validate_contract(_broken(s, d)).select("booking_id", F.concat_ws(",", "violations").alias("codes"), (F.size("violations") == 0).alias("valid")))
query("payload_cast", FEATURE_SPEC, B("""
SELECT * REPLACE ('BB' AS meal, TRY_CAST(CASE WHEN lead_time % 29 = 0 THEN 'soon' ELSE CAST(lead_time AS VARCHAR) END AS INT) AS lead_time) FROM bookings"""))(
    lambda s, d: C.payload_cast(bookings(s, d).drop("meal").withColumn(
        "lead_time", F.when(F.col("lead_time") % 29 == 0, "soon").otherwise(F.col("lead_time").cast("string")))))

# --- Profiling ------------------------------------------------------------------

_RATE_COLUMNS = ["hotel", "deposit_type", "customer_type", "market_segment"]


@query("rate_by", "variable:s value:s rate:d n:i", B(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS value, avg(is_canceled) AS rate, count(is_canceled) AS n FROM bookings WHERE {c} IS NOT NULL GROUP BY {c}" for c in _RATE_COLUMNS)))
def rate_by(s, d):
    return P.rates_by(bookings(s, d), _RATE_COLUMNS)


query("class_balance", "label:s n:i percent:e", B("""
SELECT CASE is_canceled WHEN 0 THEN 'No cancelada' ELSE 'Cancelada' END AS label, count(*) AS n,
  round_even(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent FROM bookings GROUP BY is_canceled"""))(lambda s, d: P.class_balance(bookings(s, d)))
query("numeric_summary", "variable:s count:i mean:e std:e min:e p25:e p50:e p75:e max:e", B(" UNION ALL ".join(f"""
SELECT '{c}' AS variable, count({c}) AS count, round_even(avg({c}), 2) AS mean, round_even(stddev_samp({c}), 2) AS std, round_even(CAST(min({c}) AS DOUBLE), 2) AS min,
  round_even(quantile_cont(CAST({c} AS DOUBLE), 0.25), 2) AS p25, round_even(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS p50,
  round_even(quantile_cont(CAST({c} AS DOUBLE), 0.75), 2) AS p75, round_even(CAST(max({c}) AS DOUBLE), 2) AS max FROM bookings""" for c in S.SUMMARY_COLUMNS)))(
    lambda s, d: P.numeric_summary(bookings(s, d)))
query("describe_text", "variable:s count:i unique:i top:s freq:i", B(" UNION ALL ".join(f"""
(WITH g AS (SELECT {c} AS v, count(*) AS n FROM bookings WHERE {c} IS NOT NULL GROUP BY {c})
SELECT '{c}' AS variable, sum(n) AS count, count(*) AS "unique", (SELECT v FROM g ORDER BY n DESC, v LIMIT 1) AS top, max(n) AS freq FROM g)""" for c in S.CATEGORICAL)))(
    lambda s, d: P.describe_text(bookings(s, d), S.CATEGORICAL))
query("missing_share", "column:s missing:i percent:d", B("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS percent FROM bookings"
    for c in ["booking_id", *S.FEATURES, "is_canceled"]) + ") AS m WHERE missing > 0"))(lambda s, d: P.missing_share(bookings(s, d)))
query("absence_signal", "variable:s present:b rate:d n:i", B(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} IS NOT NULL AS present, avg(is_canceled) AS rate, count(*) AS n FROM bookings GROUP BY 2" for c in ("company", "agent"))))(
    lambda s, d: P.absence_signal(bookings(s, d)))
_BAND_SQL = "CASE WHEN lead_time <= 7 THEN '0-7' WHEN lead_time <= 30 THEN '8-30' WHEN lead_time <= 90 THEN '31-90' WHEN lead_time <= 180 THEN '91-180' WHEN lead_time <= 365 THEN '181-365' ELSE '365+' END"
query("lead_time_band", "booking_id:i band:s", B(f"SELECT booking_id, {_BAND_SQL} AS band FROM bookings"))(
    lambda s, d: bookings(s, d).select("booking_id", P.lead_time_band().alias("band")))
query("rate_lead_band", "band:s rate:d n:i", B(f"SELECT {_BAND_SQL} AS band, avg(is_canceled) AS rate, count(*) AS n FROM bookings GROUP BY 1"))(
    lambda s, d: P.rate_lead_band(bookings(s, d)))
query("rate_deposit", "value:s rate:d n:i", B("SELECT deposit_type AS value, avg(is_canceled) AS rate, count(*) AS n FROM bookings GROUP BY 1"))(
    lambda s, d: P.rate_deposit(bookings(s, d)))
query("leak_parking", "flag:b scope:s n:i rate:d", B("""
SELECT required_car_parking_spaces > 0 AS flag, 'all' AS scope, count(*) AS n, avg(is_canceled) AS rate FROM bookings GROUP BY 1
UNION ALL SELECT required_car_parking_spaces > 0, 'No Deposit', count(*), avg(is_canceled) FROM bookings WHERE deposit_type = 'No Deposit' GROUP BY 1"""))(
    lambda s, d: P.leak_parking(bookings(s, d)))
query("leak_room", "moved:b rate:d n:i", B("SELECT reserved_room_type <> assigned_room_type AS moved, avg(is_canceled) AS rate, count(*) AS n FROM bookings GROUP BY 1"))(
    lambda s, d: P.leak_room(bookings(s, d)))

_OPT = [c for c in S.CATEGORICAL if c not in (*S.RARE_COLUMNS, "arrival_date_month")]
_MONTH_SQL = "list_position([" + ", ".join(f"'{m}'" for m in S.MONTHS) + "], arrival_date_month)"
_TOPS = {"country": S.TOP_COUNTRIES, "agent": S.TOP_AGENTS, "company": S.TOP_COMPANIES}
query("form_options", "field:s position:i value:s", B(
    ", tops AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS field, row_number() OVER (ORDER BY count(*) DESC, {c}) AS r, {c} AS v FROM bookings WHERE {c} IS NOT NULL GROUP BY {c} QUALIFY r <= {k}" for c, k in _TOPS.items())
    + ") " + " UNION ALL ".join(f"SELECT '{c}' AS field, row_number() OVER (ORDER BY {c}) AS position, {c} AS value FROM bookings WHERE {c} IS NOT NULL GROUP BY {c}" for c in _OPT)
    + f""" UNION ALL SELECT 'arrival_date_month', row_number() OVER (ORDER BY {_MONTH_SQL}), arrival_date_month FROM bookings GROUP BY arrival_date_month
UNION ALL SELECT field, r + CASE WHEN field = 'company' THEN 1 ELSE 0 END, v FROM tops
UNION ALL SELECT 'agent', 1 + count(*), 'Desconocido' FROM tops WHERE field = 'agent' UNION ALL SELECT 'company', 1, 'no_company'"""))(
    lambda s, d: P.form_options(bookings(s, d)))
query("value_counts", "value:s n:i share:d", B("SELECT agent AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM bookings WHERE agent IS NOT NULL GROUP BY 1"))(
    lambda s, d: P.value_counts(bookings(s, d), "agent"))
query("duplicate_rows", "total:i duplicates:i", """
SELECT sum(n) AS total, sum(n - 1) AS duplicates FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars) AS g""")(
    lambda s, d: P.duplicate_rows(table(s, d, "documents").drop("doc_id"), digest_text=True))

_CORR = [*S.NUMERIC, S.TARGET, "arrival_date_year"]
_corr = lambda a, b: f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
_PAIRS = [(a, b) for i, a in enumerate(_CORR) for b in _CORR[i:]]
query("corr_matrix", "a:s b:s r:d", B(
    ", one AS (SELECT " + ", ".join(f"{_corr(a, b)} AS r{i}" for i, (a, b) in enumerate(_PAIRS)) + " FROM bookings), cells AS ("
    + " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, r{i} AS r FROM one" for i, (a, b) in enumerate(_PAIRS) for x, y in {(a, b), (b, a)})
    + ") SELECT a, b, CASE WHEN isfinite(r) THEN r END AS r FROM cells"))(
    lambda s, d: P.corr_matrix(bookings(s, d), _CORR))
query("corr_rank", "variable:s r:d", B(" UNION ALL ".join(f"SELECT '{c}' AS variable, {_corr(c, S.TARGET)} AS r FROM bookings" for c in S.NUMERIC)))(
    lambda s, d: P.corr_rank(bookings(s, d), S.NUMERIC, S.TARGET))
query("crosstab", "customer_type:s n_0:i n_1:i pct_0:d pct_1:d", B("""
SELECT customer_type, count(*) FILTER (WHERE is_canceled = 0) AS n_0, count(*) FILTER (WHERE is_canceled = 1) AS n_1,
  100.0 * count(*) FILTER (WHERE is_canceled = 0) / count(*) AS pct_0, 100.0 * count(*) FILTER (WHERE is_canceled = 1) / count(*) AS pct_1
FROM bookings GROUP BY customer_type"""))(lambda s, d: P.crosstab(bookings(s, d), "customer_type", "is_canceled", [0, 1]))
_GROUPED = ["lead_time", "adr", "stays_in_week_nights"]
query("group_min_mean_max", "market_segment:s " + " ".join(f"{c}_{n}:d" for c in _GROUPED for n in ("min", "mean", "max")), B(
    "SELECT market_segment, " + ", ".join(f"min({c}) AS {c}_min, avg({c}) AS {c}_mean, max({c}) AS {c}_max" for c in _GROUPED) + " FROM bookings GROUP BY 1"))(
    lambda s, d: P.group_min_mean_max(bookings(s, d), "market_segment", _GROUPED))
query("histogram", "bin:i low:d high:d n:i", """
WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events),
b AS (SELECT least(floor((value - lo) / w), 19) AS bin, count(*) AS n FROM events, r GROUP BY 1)
SELECT g.i AS bin, lo + g.i * w AS low, lo + (g.i + 1) * w AS high, coalesce(n, 0) AS n FROM range(20) AS g(i) JOIN r ON true LEFT JOIN b ON b.bin = g.i""")(
    lambda s, d: P.histogram(table(s, d, "events"), "value", 20))
_INFO_TYPES = {"booking_id": "bigint", "children": "double", "adr": "double", "reservation_status_date": "date",
               **{c: "string" for c in (*S.CATEGORICAL, "assigned_room_type", "reservation_status")}}
_INFO_COLUMNS = RAW_SPEC.split()
query("table_info", "column:s type:s rows:i non_null:i", B(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_INFO_TYPES.get(c, 'int')}' AS type, count(*) AS rows, count({c}) AS non_null FROM bookings"
    for c in [x.split(":")[0] for x in (RAW_SPEC + EXTRA_SPEC).split()])))(lambda s, d: P.table_info(bookings(s, d)))
query("delta_vs_base", "value:s rate:d delta_points:d", B("SELECT customer_type AS value, avg(is_canceled) AS rate, (avg(is_canceled) - 0.37) * 100 AS delta_points FROM bookings GROUP BY 1"))(
    lambda s, d: P.delta_vs_base(P.rate_by(bookings(s, d), "customer_type"), "rate"))
query("union_target", "is_canceled:i n:i", B("""SELECT is_canceled, count(*) AS n FROM bookings WHERE coalesce(adults,0) + coalesce(children,0) + coalesce(babies,0) > 0
  AND coalesce(stays_in_week_nights,0) + coalesce(stays_in_weekend_nights,0) > 0 AND coalesce(NOT (adr < 0 OR adr >= 5400), true) GROUP BY 1"""))(
    lambda s, d: (lambda f: P.union_target(f.where("split = 'train'"), f.where("split = 'test'")))(frame_split(s, d)).groupBy("is_canceled").agg(F.count(F.lit(1)).alias("n")))

# --- Samples --------------------------------------------------------------------

from staymill.catalog.base import mix_sql  # noqa: E402

query("head_n", RAW_SPEC + EXTRA_SPEC, B("SELECT * FROM bookings ORDER BY booking_id LIMIT 100"))(lambda s, d: SP.head_n(bookings(s, d), 100))
query("sample_n", RAW_SPEC, B(f"SELECT * FROM bookings ORDER BY {mix_sql('booking_id', 42)}, booking_id LIMIT 1500"))(lambda s, d: SP.sample_n(bookings(s, d), 1500))
