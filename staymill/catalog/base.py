"""Registry of queries: each has a Spark side and, where SQL can say it, a checking text.

A spec such as "value:s rate:d n:i" names the result columns and their types once and is
applied to both sides: s text, i bigint, d double at 6 decimals, e double as it is, b boolean."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.hashing import mix_sql
from staymill.functions.session import materialise
from staymill.operators.clean import clean
from staymill.operators.split import split_stratified
from staymill.sources.bookings import bookings, bookings_cte
from staymill.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _parse(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in spec.split()]


def shape(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, kind in _parse(spec):
        c = F.col(f"`{name}`")
        c = {
            "s": lambda: c.cast("string"),
            "i": lambda: c.cast("bigint"),
            "d": lambda: F.round(c.cast("double"), 6) + F.lit(0.0),
            "e": lambda: c.cast("double"),
            "b": lambda: c.cast("boolean"),
        }[kind]()
        cols.append(c.alias(name))
    return df.select(*cols)


def shape_sql(sql: str, spec: str) -> str:
    cols = []
    for name, kind in _parse(spec):
        q = f'"{name}"'
        cols.append({
            "s": f"CAST({q} AS VARCHAR) AS {q}",
            "i": f"CAST({q} AS BIGINT) AS {q}",
            "d": f"round(CAST({q} AS DOUBLE), 6) + CAST(0 AS DOUBLE) AS {q}",
            "e": f"CAST({q} AS DOUBLE) AS {q}",
            "b": f"CAST({q} AS BOOLEAN) AS {q}",
        }[kind])
    return f"SELECT {', '.join(cols)} FROM (\n{sql.strip()}\n) AS result"


def query(name: str, spec: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name; `sql` may use the frames of `with_frames`."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: shape(fn(spark, sf_dir), spec)
        if sql is not None:
            ORACLES[name] = shape_sql(sql, spec)
        return fn

    return add


# --- Frames shared by many queries ---------------------------------------------

LEAK_SQL = ", ".join(S.LEAKAGE_COLUMNS)
KEEP_SQL = (
    "coalesce(adults, 0) + coalesce(children, 0) + coalesce(babies, 0) > 0 "
    "AND coalesce(stays_in_week_nights, 0) + coalesce(stays_in_weekend_nights, 0) > 0 "
    "AND coalesce(NOT (adr < 0 OR adr >= 5400), true)"
)
ABSENT_SQL = "(" + ", ".join(f"'{w}'" for w in S.ABSENT_WORDS) + ")"

_FRAMES = {
    "bookings": bookings_cte(),
    "cleaned": f"cleaned AS (SELECT * EXCLUDE ({LEAK_SQL}) FROM bookings WHERE {KEEP_SQL})",
    "keys": f"""keys AS (SELECT * REPLACE (
        CASE WHEN agent IS NULL OR lower(trim(agent)) IN {ABSENT_SQL} THEN NULL ELSE trim(agent) END AS agent,
        CASE WHEN country IS NULL OR lower(trim(country)) IN {ABSENT_SQL} THEN NULL ELSE trim(country) END AS country,
        CASE WHEN company IS NULL OR lower(trim(company)) IN {ABSENT_SQL} THEN NULL ELSE trim(company) END AS company)
        FROM cleaned)""",
    "split": f"""class_n AS (SELECT is_canceled AS c, count(*) AS n, sum(count(*)) OVER () AS total FROM cleaned GROUP BY 1),
      share AS (SELECT c, n, ceil(total / 5) AS want, floor(n * ceil(total / 5) / total) AS low,
                       n * ceil(total / 5) / total - floor(n * ceil(total / 5) / total) AS rest FROM class_n),
      quota AS (SELECT c, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= want - sum(low) OVER () THEN 1 ELSE 0 END AS q FROM share),
      ranked AS (SELECT k.*, row_number() OVER (PARTITION BY is_canceled ORDER BY {mix_sql('booking_id', S.SEED)}, booking_id) AS rk FROM keys k),
      split AS (SELECT r.* EXCLUDE (rk), CASE WHEN rk <= q THEN 'test' ELSE 'train' END AS split FROM ranked r JOIN quota ON is_canceled = c)""",
    # Three formula scores stand for three models; many ties on purpose.
    "scores": """scores AS (
        SELECT 'alpha' AS model, 0 AS position, booking_id, is_canceled AS y, CAST((booking_id * 40503) % 61 + 30 * is_canceled AS DOUBLE) / 100 AS p FROM cleaned
        UNION ALL SELECT 'beta', 1, booking_id, is_canceled, CAST((booking_id * 48271) % 83 + 11 * is_canceled AS DOUBLE) / 100 FROM cleaned
        UNION ALL SELECT 'gamma', 2, booking_id, is_canceled, CAST((booking_id * 69621) % 71 + 20 * is_canceled AS DOUBLE) / 100 FROM cleaned)""",
    "judged": "judged AS (SELECT *, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred FROM scores)",
    "metrics": """counted AS (SELECT model, position,
          CAST(count(*) FILTER (WHERE y = 1 AND pred = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE y = 0 AND pred = 1) AS DOUBLE) AS fp,
          CAST(count(*) FILTER (WHERE y = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE y = 0 AND pred = 0) AS DOUBLE) AS tn
          FROM judged GROUP BY 1, 2),
      by_p AS (SELECT model, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM judged GROUP BY 1, 2),
      run AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY p) AS cum FROM by_p),
      auc AS (SELECT model, sum(pos * (cum - neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc FROM run GROUP BY 1),
      metrics AS (SELECT c.model, position, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
          CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
          CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, roc_auc
          FROM counted c JOIN auc a ON c.model = a.model)""",
}
_NEEDS = {
    "bookings": [], "cleaned": ["bookings"], "keys": ["cleaned"], "split": ["keys"],
    "scores": ["cleaned"], "judged": ["scores"], "metrics": ["judged"],
}


def with_frames(frame: str, body: str) -> str:
    """A WITH clause that defines `frame` and what it builds on, then the body.

    A body that starts with a comma goes on with further members."""
    order: list[str] = []

    def visit(f: str) -> None:
        for need in _NEEDS[f]:
            visit(need)
        if f not in order:
            order.append(f)

    visit(frame)
    text = "WITH " + ",\n".join(_FRAMES[f] for f in order)
    body = body.strip()
    return text + ("" if body.startswith(",") else "\n") + body


def frame_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(bookings(spark, sf_dir))


def frame_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows are written once, since the split counts them before it marks them."""
    return split_stratified(materialise(frame_cleaned(spark, sf_dir), "cleaned"))


# (multiplier, modulus, lift of the positives) of the formula scores
SCORE_FORMULAS = {"alpha": (40503, 61, 30), "beta": (48271, 83, 11), "gamma": (69621, 71, 20)}


def frame_scores(spark: SparkSession, sf_dir: str, models: tuple[str, ...] = ("alpha", "beta", "gamma")) -> DataFrame:
    """Long score frame (model, key, y, p, pred): one pass over the rows, unrolled per model."""
    df = frame_cleaned(spark, sf_dir).select(S.KEY, F.col(S.TARGET).alias("y"))
    rows = []
    for m in models:
        a, mod, lift = SCORE_FORMULAS[m]
        p = (F.pmod(F.col(S.KEY) * a, F.lit(mod)) + lift * F.col("y")).cast("double") / 100
        rows.append(F.struct(F.lit(m).alias("model"), p.alias("p")))
    long = df.select(S.KEY, "y", F.inline(F.array(*rows)))
    return long.withColumn("pred", (F.col("p") >= S.THRESHOLD).cast("int"))


__all__ = ["F", "S", "bookings", "table", "mix_sql", "query", "with_frames", "frame_cleaned", "frame_split", "frame_scores"]
