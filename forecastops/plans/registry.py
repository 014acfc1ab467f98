"""Registry of named queries with the SQL that gives the same result, and the SQL's shared parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6
#: rounding first to more digits keeps a sum's last bits from deciding a tie
GUARD_DIGITS = 9


def query(name: str, sql: str | None = None, rounded: str = "") -> Callable[[Query], Query]:
    """Register a query; its double columns are rounded, as are the SQL's columns listed in ``rounded``."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return round_doubles(fn(spark, folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = round_sql(sql, rounded.split())
        return fn

    return register


def round_doubles(df: DataFrame) -> DataFrame:
    short = lambda c: F.round(F.round(c, GUARD_DIGITS), DIGITS).alias(c)
    return df.select(*[short(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema])


def round_sql(sql: str, columns: list[str]) -> str:
    if not columns:
        return sql
    # adding 0 turns a negative zero into zero
    parts = ", ".join(f"ROUND(ROUND(CAST({c} AS DOUBLE), {GUARD_DIGITS}), {DIGITS}) + 0 AS {c}" for c in columns)
    return f"SELECT * REPLACE ({parts}) FROM ({sql}) AS t"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- common table expressions ---------------------------------------------------------------------------------------

TX = """tx AS (
  SELECT o.o_custkey AS customer_id, l.l_partkey AS product_id, o.o_orderkey AS transaction_id,
         CAST(o.o_orderdate AS DATE) AS tx_date, l.l_quantity AS units, l.l_extendedprice AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

LAST_DAY = "last_day AS (SELECT CAST(MAX(o_orderdate) AS DATE) AS d FROM orders)"

PANEL = """panel AS (
  SELECT c.c_nationkey AS customer_id, p.p_type AS brand,
         CAST(isoyear(tx.tx_date) * 100 + weekofyear(tx.tx_date) AS INTEGER) AS week, SUM(tx.units) AS y
  FROM tx JOIN customer c ON tx.customer_id = c.c_custkey JOIN part p ON tx.product_id = p.p_partkey
  GROUP BY 1, 2, 3)"""

SERIES = "PARTITION BY customer_id, brand ORDER BY week"


def lag_sql(n: int = 4) -> str:
    return ", ".join(
        f"CASE WHEN LAG(week, {k}) OVER ({SERIES}) = week - {k} THEN COALESCE(LAG(y, {k}) OVER ({SERIES}), 0) "
        f"ELSE 0 END AS w_m{k}_total"
        for k in range(1, n + 1)
    )


def rolling_sql(family) -> str:
    from forecastops.operators.features import rolling_name

    parts = []
    for k, fn in family:
        frame = f"({SERIES} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        parts.append(f"CASE WHEN COUNT(y) OVER {frame} = {k} THEN {fn}(y) OVER {frame} ELSE 0 END AS {rolling_name(k, fn)}")
    return ", ".join(parts)


#: the rolling columns the monitoring queries use
SHORT_FAMILY = ((3, "max"), (4, "sum"), (12, "avg"))

FEATURES = f"""lagged AS (SELECT customer_id, brand, week, y, {lag_sql()}, {rolling_sql(SHORT_FAMILY)} FROM panel),
features AS (
  SELECT *, w_m1_total + w_m2_total + w_m3_total + w_m4_total AS sum_p4w, CAST(week % 100 AS INTEGER) AS week_of_year
  FROM lagged)"""

BITS = " || ".join(f"CASE WHEN w_m{k}_total <> 0 THEN '1' ELSE '0' END" for k in range(1, 5))

GROUPED = f"""patterned AS (SELECT *, {BITS} AS "group" FROM features),
grouped AS (
  SELECT *, 'group_stat_' || CAST(LENGTH(REPLACE("group", '0', '')) - 1 AS VARCHAR) AS stats_group,
         w_m1_total AS prediction, CAST(LEAST(CEIL(week_of_year / 13.0), 4) AS INTEGER) AS quarter,
         CASE WHEN brand IN ('PROMO', 'ECONOMY') THEN 'VALUE' ELSE 'REGULAR' END AS cust_category
  FROM patterned WHERE "group" <> '0000')"""

BASE = [TX, PANEL, FEATURES, GROUPED]

#: per customer, the units of each of the newest four selling weeks; the segment follows from how many of them sold and
#: from the quarter of all customers that the sum falls into
SIX = """newest AS (
  SELECT list_sort(list_distinct(list(tx_date - CAST(isodow(tx_date) - 1 AS INTEGER))))[-4:] AS mondays FROM tx, last_day WHERE tx_date BETWEEN d - 28 AND d),
amounts AS (
  SELECT c_custkey AS customer_id, list_transform(range(1, len(any_value(mondays)) + 1), lambda i: coalesce(list_sum(list_filter(
           list_transform(list((tx_date, units)), lambda t: CASE WHEN t[1] - CAST(isodow(t[1]) - 1 AS INTEGER) = any_value(mondays)[i] THEN t[2] END), lambda u: u IS NOT NULL)), 0)) AS sold
  FROM customer CROSS JOIN newest LEFT JOIN (SELECT * FROM tx, last_day WHERE tx_date >= d - 56) t ON t.customer_id = c_custkey GROUP BY 1),
signs AS (
  SELECT customer_id, coalesce(list_sum(sold), 0) AS total_units_4w, CAST(len(list_filter(sold, lambda u: u > 0)) AS INTEGER) AS weeks_with_purchase,
         array_to_string(list_transform(sold, lambda u: CAST(CAST(u > 0 AS INTEGER) AS VARCHAR)), '') AS purchase_pattern FROM amounts),
quarters AS (SELECT *, CAST(ntile(4) OVER (ORDER BY total_units_4w, customer_id) AS INTEGER) AS volume_quartile FROM signs),
six AS (
  SELECT *, 'SEGMENT_' || CASE weeks_with_purchase WHEN 0 THEN 6 WHEN 1 THEN 5 WHEN 4 THEN CASE volume_quartile WHEN 4 THEN 1 WHEN 3 THEN 2 ELSE 6 END
    ELSE CASE WHEN volume_quartile > 2 THEN 3 ELSE 4 END END AS segment FROM quarters)"""

#: first production week; earlier weeks are the baseline
SPLIT_WEEK = 200001
