"""Registered queries: window operators on series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import finite
from ..operators import periodic, series
from .periods import _sales, history, money
from .views import sales, table

KEYS = ("order_id", "line_no", "part_id", "supplier_id")


def monthly_by_type(spark: SparkSession, sf: str) -> DataFrame:
    rows = sales(spark, sf, "inv_date", "type", "quantity", "usd_total").withColumnsRenamed(
        {"inv_date": "sale_date", "usd_total": "revenue"}
    )
    return periodic.monthly_history(rows, ("type",))


def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    monthly = monthly_by_type(spark, sf)
    return money(series.rolling_mean(monthly, ("type",), "sale_month", ("quantity", "revenue"), 3), "quantity", "revenue")


def qty_ma3(spark: SparkSession, sf: str) -> DataFrame:
    """Row-level moving average per channel: few and very long series."""
    rows = sales(spark, sf, *KEYS, "inv_date", "region", "quantity")
    order = ("inv_date", *KEYS, "quantity")  # the measure last: full ties then give the same means
    averaged = series.moving_average(rows, ("region",), order, "quantity", 3, "qty_ma3")
    return money(averaged, "quantity")


def tail_mean(spark: SparkSession, sf: str) -> DataFrame:
    monthly = periodic.monthly_history(history(spark, sf, "type"), ("channel", "type"))
    return series.tail_mean(monthly, ("channel", "type"), "sale_month", ("quantity", "revenue"), 3)


def forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Two of three event values are missing; each user's last one is carried on."""
    events = table(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"),
    )
    return series.forward_fill(events, ("user_id",), ("ts", "event_id"), "value")


def log_seasonal_diff(spark: SparkSession, sf: str) -> DataFrame:
    return series.log_seasonal_diff(monthly_by_type(spark, sf), ("type",), "sale_month", "quantity")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def clean_series(spark: SparkSession, sf: str) -> DataFrame:
    """Infinite, not-a-number and missing values become 0; logs and back."""
    k, v = F.col("event_id"), F.col("value")
    dirty = (
        F.when(k % 5 == 0, float("inf")).when(k % 7 == 0, float("nan")).when(k % 11 == 0, None).otherwise(v)
    )
    back = F.exp(F.log(F.greatest(v, F.lit(1.0))))
    return table(spark, sf, "events").select(
        "event_id", finite(dirty).alias("value"), F.round(back, 2).alias("back")
    )


QUERIES = {
    "rolling_mean": rolling_mean,
    "qty_ma3": qty_ma3,
    "tail_mean": tail_mean,
    "forward_fill": forward_fill,
    "log_seasonal_diff": lambda s, d: rounded(
        money(log_seasonal_diff(s, d), "quantity", "revenue"), "log_value", "diff_1", "diff_seasonal"
    ),
    "acf": lambda s, d: rounded(
        series.autocorrelation(log_seasonal_diff(s, d), ("type",), "sale_month", "diff_seasonal"), "acf"
    ),
    "clean_series": clean_series,
}

_MONTHLY = """, monthly AS (SELECT type, last_day(inv_date) AS sale_month, sum(quantity) AS quantity,
  sum(usd_total) AS revenue FROM usd GROUP BY ALL)"""
_OVER = "OVER (PARTITION BY type ORDER BY sale_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
_LOGS = f"""{_MONTHLY}, logs AS (SELECT *, ln(greatest(CAST(quantity AS DOUBLE), 1)) AS log_value FROM monthly),
  firsts AS (SELECT *, log_value - lag(log_value) OVER (PARTITION BY type ORDER BY sale_month) AS diff_1 FROM logs),
  diffs AS (SELECT *, diff_1 - lag(diff_1, 12) OVER (PARTITION BY type ORDER BY sale_month) AS diff_seasonal FROM firsts)"""
_ORDER = ", ".join(KEYS)

ORACLES = {
    "rolling_mean": _sales(
        f"""{_MONTHLY} SELECT type, sale_month, CAST(quantity AS DOUBLE) AS quantity, CAST(revenue AS DOUBLE) AS revenue,
        CAST(sum(quantity) {_OVER} AS DOUBLE) / count(*) {_OVER} AS quantity_mean,
        CAST(sum(revenue) {_OVER} AS DOUBLE) / count(*) {_OVER} AS revenue_mean FROM monthly"""
    ),
    "qty_ma3": _sales(
        f"""SELECT {_ORDER}, inv_date, region, CAST(quantity AS DOUBLE) AS quantity,
        CAST(sum(quantity) OVER w AS DOUBLE) / count(*) OVER w AS qty_ma3 FROM sales
        WINDOW w AS (PARTITION BY region ORDER BY inv_date, {_ORDER}, quantity ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
    ),
    "tail_mean": _sales(
        """SELECT channel, type, max(sale_month) AS last_period, CAST(sum(quantity) AS DOUBLE) / count(*) AS quantity_mean,
        CAST(sum(revenue) AS DOUBLE) / count(*) AS revenue_mean FROM (
        SELECT *, row_number() OVER (PARTITION BY channel, type ORDER BY sale_month DESC) AS age FROM (
        SELECT region AS channel, type, last_day(inv_date) AS sale_month, sum(quantity) AS quantity, sum(usd_total) AS revenue
        FROM usd GROUP BY ALL)) WHERE age <= 3 GROUP BY channel, type"""
    ),
    "forward_fill": """SELECT user_id, ts, event_id, CAST(ts AS DATE) AS day,
        last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events""",
    "log_seasonal_diff": _sales(
        f"""{_LOGS} SELECT type, sale_month, CAST(quantity AS DOUBLE) AS quantity, CAST(revenue AS DOUBLE) AS revenue,
        round(log_value, 6) AS log_value, round(diff_1, 6) AS diff_1, round(diff_seasonal, 6) AS diff_seasonal FROM diffs"""
    ),
    "acf": _sales(
        f"""{_LOGS}, centred AS (SELECT type, sale_month, diff_seasonal - avg(diff_seasonal) OVER (PARTITION BY type) AS x
        FROM diffs WHERE diff_seasonal IS NOT NULL),
        lagged AS (SELECT type, lag, x, CASE lag WHEN 1 THEN lag(x, 1) OVER w WHEN 2 THEN lag(x, 2) OVER w
          WHEN 3 THEN lag(x, 3) OVER w ELSE lag(x, 4) OVER w END AS y
          FROM centred CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS lag) WINDOW w AS (PARTITION BY type, lag ORDER BY sale_month))
        SELECT type, lag, round(sum(x * y) / sum(x * x), 6) AS acf FROM lagged GROUP BY type, lag"""
    ),
    "clean_series": """SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0 THEN 0 ELSE value END AS value,
        round(exp(ln(greatest(value, 1))), 2) AS back FROM events""",
}
