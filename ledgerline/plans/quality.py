"""Registered queries: data-quality checks and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import periodic, quality
from ..session import settle
from .cleaning import KEYS, RAW_SQL, _nulls, raw_sales, staged
from .cleaning import _staging as staging_sql
from .periods import CUTOFF, _sales, money
from .views import sales, table

REASONS = ("FURNITURE", "BUILDING", "MACHINERY")
PROFILED = ("Customer", "ItemCode", "Currency", "ShipTo", "Region", "Product")


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.clean import normalise_missing

    return quality.null_profile(normalise_missing(raw_sales(spark, sf).select(*PROFILED)))


def anomalies(spark: SparkSession, sf: str) -> DataFrame:
    rows = sales(spark, sf, "inv_date", "type", "region", "quantity").groupBy(
        "type", "region", F.last_day("inv_date").alias("sale_month")
    )
    monthly = rows.agg(F.sum("quantity").cast("double").alias("quantity"))
    found = quality.anomalies(monthly, ("type", "region"), "quantity", 2.0)
    return found.withColumn("z_score", F.round("z_score", 6))


def dq_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = sales(spark, sf, "inv_date", "region", "quantity", "usd_total").withColumnsRenamed(
        {"inv_date": "sale_date", "usd_total": "revenue"}
    )
    monthly = money(periodic.monthly_history(rows, ("region",)), "quantity", "revenue").withColumns(
        {"constant": F.lit(1.0), "gaps": F.when(F.month("sale_month") % 4 != 0, F.col("quantity"))}
    )
    return quality.feature_checks(monthly, ("quantity", "revenue", "constant", "gaps"), "sale_month", CUTOFF)


def dq_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    checked = quality.reconcile(sales(spark, sf, "region", "usd_total"), "region", "usd_total")
    return money(checked, "slice_sum", "total")


def run_audit(spark: SparkSession, sf: str) -> DataFrame:
    return quality.audit(
        {
            "orders": (table(spark, sf, "orders"), "o_orderdate"),
            "lineitem": (table(spark, sf, "lineitem"), "l_shipdate"),
            "events": (table(spark, sf, "events"), "ts"),
        },
        "run-1",
    )


def inject_nulls(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price")
    )
    return quality.inject_nulls(rows, "price", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), 0.05)


def price_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of a continuous measure, per order year: hardly two prices are equal."""
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"))
    boxes = quality.box_stats(orders, "price", ("year",))
    return boxes.withColumns({c: F.round(c, 4) for c in ("lowest", "q1", "median", "q3", "highest")})


def distinct_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct users and event types per month from stored daily sketches, next to the exact counts."""
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    columns = ("user_id", "event_type", "event_id")
    stored = settle(quality.distinct_sketches(events, ("day",), columns))
    merged = quality.merge_sketches(stored.withColumn("month", F.last_day("day")), ("month",))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("s")) for c in columns])
    exact = events.select(F.last_day("day").alias("month"), F.inline(pairs)).groupBy("month", "column_name")
    exact = exact.agg(F.count_distinct("s").alias("distinct_values"))
    estimate = quality.distinct_estimate(F.col("sketch"))
    off = F.abs(estimate - F.col("distinct_values")) / F.col("distinct_values")
    joined = merged.join(exact, ["month", "column_name"])
    return joined.select("month", "column_name", "rows", "distinct_values", (off <= 3 * quality.SKETCH_ERROR).alias("within_error"))


QUERIES = {
    "price_boxes": price_boxes,
    "distinct_by_month": distinct_by_month,
    "dq_not_null": lambda s, d: quality.not_null(staged(s, d), ("sale_date", "sku", "quantity")),
    "dq_unique": lambda s, d: quality.repeated_keys(table(s, d, "lineitem"), ("l_orderkey", "l_linenumber")),
    "dq_accepted": lambda s, d: quality.unaccepted(table(s, d, "customer"), "c_mktsegment", REASONS),
    "dq_fk": lambda s, d: quality.orphans(
        table(s, d, "events"), "user_id", table(s, d, "supplier"), "s_suppkey"
    ),
    "dq_reconcile": dq_reconcile,
    "dq_duplicates": lambda s, d: quality.duplicates(table(s, d, "lineitem"), ("l_orderkey", "l_linenumber")),
    "dq_features": dq_features,
    "ingest_manifest": lambda s, d: quality.manifest(raw_sales(s, d)),
    "anomalies": anomalies,
    "run_audit": run_audit,
    "null_profile": null_profile,
    "profile_numeric": lambda s, d: quality.numeric_profile(
        table(s, d, "lineitem"), ("l_quantity", "l_extendedprice", "l_discount")
    ),
    "quantity_histogram": lambda s, d: quality.histogram(
        table(s, d, "lineitem"), "l_quantity", 5, ("l_returnflag",)
    ),
    "box_stats": lambda s, d: quality.box_stats(table(s, d, "lineitem"), "l_quantity", ("l_returnflag",)),
    "inject_nulls": inject_nulls,
}

_NULLED = ", ".join(f'{_nulls(chr(34) + c + chr(34))} AS "{c}"' for c in PROFILED)
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count("{c}") AS missing_count,
    round((count(*) - count("{c}")) * 100.0::DOUBLE / count(*), 4) AS missing_percent FROM cells"""
    for c in PROFILED
)
_MONTHS = """, monthly AS (SELECT region, last_day(inv_date) AS sale_month, CAST(sum(quantity) AS DOUBLE) AS quantity,
  CAST(sum(usd_total) AS DOUBLE) AS revenue, 1.0 AS constant FROM usd GROUP BY ALL),
  features AS (SELECT *, CASE WHEN month(sale_month) % 4 <> 0 THEN quantity END AS gaps FROM monthly)"""



def _manifest() -> str:
    """Every cell with its length, a missing one as a dash; the md5 of the row as a number, summed."""
    columns = [*KEYS, *(f'"{c}"' for c in ("PI", "Customer", "ItemCode", "Product", "Quantity", "Price", "Total", "Currency",
               "InvDate", "ShipDate", "ShipTo", "Country", "Region")), "'note'", "'pcs'", "source_sheet"]
    cells = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    row = " || '|' || ".join(cells)
    return f"""WITH {RAW_SQL} SELECT source_sheet, count(*) AS rows,
        CAST(sum(CAST('0x' || md5({row})[1:15] AS BIGINT)) AS VARCHAR) AS content_hash FROM raw GROUP BY source_sheet"""


ORACLES = {
    "price_boxes": """WITH prices AS (SELECT year(o_orderdate) AS year, o_totalprice AS price FROM orders),
        boxes AS (SELECT year, min(price) AS lowest, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
          quantile_cont(price, 0.75) AS q3, max(price) AS highest FROM prices GROUP BY 1)
        SELECT year, round(lowest, 4) AS lowest, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(highest, 4) AS highest,
          count(*) FILTER (NOT price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
        FROM boxes JOIN prices USING (year) GROUP BY ALL""",
    "distinct_by_month": " UNION ALL ".join(
        f"""SELECT last_day(CAST(ts AS DATE)) AS month, '{c}' AS column_name, count({c}) AS rows, count(DISTINCT {c}) AS distinct_values,
        true AS within_error FROM events GROUP BY 1"""
        for c in ("user_id", "event_type", "event_id")
    ),
    "dq_not_null": f"WITH s AS ({staging_sql(None)}) "
    + " UNION ALL ".join(
        f"SELECT 'not_null_{c}' AS rule, count(*) - count({c}) AS failures FROM s" for c in ("sale_date", "sku", "quantity")
    ),
    "dq_unique": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_accepted": f"""SELECT c_mktsegment AS value, count(*) AS rows FROM customer
        WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN {REASONS} GROUP BY 1""",
    "dq_fk": "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)",
    "ingest_manifest": _manifest(),
    "dq_reconcile": _sales(
        """SELECT count(*) AS slices, CAST(sum(v) AS DOUBLE) AS slice_sum, (SELECT CAST(sum(usd_total) AS DOUBLE) FROM usd) AS total,
        CAST(sum(n) AS BIGINT) AS slice_rows, (SELECT count(*) FROM usd) AS total_rows, true AS matches
        FROM (SELECT region, sum(usd_total) AS v, count(*) AS n FROM usd GROUP BY region)"""
    ),
    "dq_duplicates": """SELECT count(*) AS rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows,
        round((count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::DOUBLE / count(*), 6) AS duplicate_ratio FROM lineitem""",
    "dq_features": _sales(
        _MONTHS + " "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, count(*) AS rows, count(*) - count({c}) AS missing, min({c}) = max({c}) AS constant,
            count(*) FILTER (sale_month >= DATE '{CUTOFF}') AS late_rows FROM features"""
            for c in ("quantity", "revenue", "constant", "gaps")
        )
    ),
    "anomalies": _sales(
        """SELECT type, region, sale_month, quantity, round(z, 6) AS z_score FROM (SELECT *,
        (quantity - avg(quantity) OVER (PARTITION BY type, region)) / stddev_samp(quantity) OVER (PARTITION BY type, region) AS z
        FROM (SELECT type, region, last_day(inv_date) AS sale_month, CAST(sum(quantity) AS DOUBLE) AS quantity FROM sales GROUP BY ALL))
        WHERE abs(z) > 2"""
    ),
    "run_audit": """SELECT 'run-1' AS run_id, 'orders' AS table_name, count(*) AS rows, CAST(max(o_orderdate) AS DATE) AS latest FROM orders
        UNION ALL SELECT 'run-1', 'lineitem', count(*), CAST(max(l_shipdate) AS DATE) FROM lineitem
        UNION ALL SELECT 'run-1', 'events', count(*), CAST(max(ts) AS DATE) FROM events""",
    "null_profile": f"WITH {RAW_SQL}, cells AS (SELECT {_NULLED} FROM raw) {_PROFILE}",
    "profile_numeric": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS values, round(CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / count({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS stddev, min({c}) AS lowest, max({c}) AS highest, count(DISTINCT {c}) AS distinct_values FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
    "quantity_histogram": "SELECT l_returnflag, CAST(floor(l_quantity / 5) * 5 AS DOUBLE) AS bin_start, count(*) AS rows FROM lineitem GROUP BY ALL",
    "box_stats": """WITH boxes AS (SELECT l_returnflag, min(l_quantity) AS lowest, quantile_cont(l_quantity, 0.25) AS q1,
        quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS highest FROM lineitem GROUP BY 1)
        SELECT boxes.*, (SELECT count(*) FROM lineitem l WHERE l.l_returnflag = boxes.l_returnflag
        AND NOT l_quantity BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers FROM boxes""",
    "inject_nulls": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN
        CAST('0x' || md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey)[1:8] AS BIGINT) >= {int(0.05 * 2**32)}
        THEN l_extendedprice END AS price FROM lineitem""",
}
