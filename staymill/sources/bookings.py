"""The bookings frame: one booking per order, with the raw file's 32 columns plus a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staymill.sources.tables import table

# One text for Spark and for the checking engine; the braces name the source tables.
BOOKINGS_SQL = """
WITH l AS (
  SELECT l_orderkey, count(*) AS n_lines, min(l_suppkey) AS supp, min(l_partkey) AS part
  FROM {lineitem} GROUP BY l_orderkey),
b AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS cust, (o.o_orderkey * 2654435761) % 4294967296 AS h,
         o.o_orderdate AS d, o.o_totalprice AS price, o.o_orderpriority AS prio, o.o_orderstatus AS st,
         c.c_mktsegment AS seg, n.n_name AS nat, n.n_regionkey AS reg,
         coalesce(l.n_lines, 0) AS nl, l.supp AS supp, p.p_type AS ptype, p.p_brand AS brand, p.p_size AS psize
  FROM {orders} o
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN {part} p ON p.p_partkey = l.part),
t AS (
  SELECT *, CASE WHEN CAST(floor(h / 4194304) AS BIGINT) % 1000
                      < 120 + (h % 400) * 0.9
                        + CASE WHEN prio = '1-URGENT' THEN 400 ELSE 0 END
                        - CASE WHEN supp % 5 = 0 THEN 150 ELSE 0 END
                 THEN 1 ELSE 0 END AS y
  FROM b)
SELECT
  k AS booking_id,
  CASE WHEN reg IN (0, 1) THEN 'Resort Hotel' ELSE 'City Hotel' END AS hotel,
  CAST(y AS INT) AS is_canceled,
  CAST(h % 400 AS INT) AS lead_time,
  CAST(year(d) AS INT) AS arrival_date_year,
  CASE month(d) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April'
    WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September'
    WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END AS arrival_date_month,
  CAST(weekofyear(d) AS INT) AS arrival_date_week_number,
  CAST(day(d) AS INT) AS arrival_date_day_of_month,
  CAST(nl % 3 AS INT) AS stays_in_weekend_nights,
  CAST(least(nl, 5) - nl % 3 AS INT) AS stays_in_week_nights,
  CAST(CASE WHEN h % 97 = 0 THEN 0 ELSE 1 + h % 3 END AS INT) AS adults,
  CASE WHEN h % 113 = 5 THEN NULL WHEN h % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(h % 2 AS DOUBLE) END AS children,
  CAST(CASE WHEN h % 97 <> 0 AND h % 41 = 0 THEN 1 ELSE 0 END AS INT) AS babies,
  CASE WHEN ptype = 'ECONOMY' THEN 'SC' WHEN ptype = 'PROMO' THEN 'FB' WHEN ptype = 'STANDARD' THEN 'HB' ELSE 'BB' END AS meal,
  nullif(nat, 'NATION_7') AS country,
  seg AS market_segment,
  CASE WHEN h % 4 = 0 THEN 'Direct' ELSE 'TA/TO' END AS distribution_channel,
  CAST(CASE WHEN cust % 29 = 0 THEN 1 ELSE 0 END AS INT) AS is_repeated_guest,
  CAST(CASE WHEN h % 19 = 0 THEN 1 + h % 3 ELSE 0 END AS INT) AS previous_cancellations,
  CAST(CASE WHEN cust % 29 = 0 THEN h % 4 ELSE 0 END AS INT) AS previous_bookings_not_canceled,
  CASE psize % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'D' ELSE 'E' END AS reserved_room_type,
  CASE WHEN y = 0 AND h % 5 = 0 THEN 'C' ELSE CASE psize % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'D' ELSE 'E' END END AS assigned_room_type,
  CAST(h % 11 % 4 AS INT) AS booking_changes,
  CASE prio WHEN '1-URGENT' THEN 'Non Refund' WHEN '2-HIGH' THEN 'Refundable' ELSE 'No Deposit' END AS deposit_type,
  CASE WHEN h % 7 = 3 THEN NULL ELSE CAST(supp AS STRING) END AS agent,
  CASE WHEN h % 17 = 0 THEN replace(brand, 'Brand#', '') END AS company,
  CAST(CASE WHEN h % 31 = 0 THEN h % 200 ELSE 0 END AS INT) AS days_in_waiting_list,
  CASE st WHEN 'F' THEN 'Transient' WHEN 'O' THEN 'Contract' ELSE 'Group' END AS customer_type,
  price / 90 - 20 AS adr,
  CAST(CASE WHEN y = 0 AND h % 13 = 0 THEN 1 ELSE 0 END AS INT) AS required_car_parking_spaces,
  CAST(h % 23 % 5 AS INT) AS total_of_special_requests,
  CASE WHEN y = 1 THEN 'Canceled' ELSE 'Check-Out' END AS reservation_status,
  CAST(d AS DATE) AS reservation_status_date
FROM t
"""

_TABLES = ("lineitem", "orders", "customer", "nation", "part")


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are reduced to one row per order before the join, so a hot order key never
    fans out; customer, nation and part are joined by whatever strategy their sizes allow."""
    return spark.sql(BOOKINGS_SQL, **{t: table(spark, sf_dir, t) for t in _TABLES})


def bookings_cte() -> str:
    """The same frame as a WITH member for the checking engine."""
    return "bookings AS (" + BOOKINGS_SQL.format(**{t: t for t in _TABLES}) + ")"
