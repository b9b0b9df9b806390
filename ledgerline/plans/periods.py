"""Registered queries: histories, monthly and quarterly aggregates, splits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import periodic
from ..operators.subscription import double
from ..session import work_dir
from ..sources import readers
from .cleaning import RAW_SQL, _strip, date_sql, raw_sales
from .views import FOCUS, SALES_SQL, dates_between, sales, table

CUTOFF = "2000-10-01"
FOCUS_TYPES = ("PROMO", "ECONOMY")


def history(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Sale date, sku, channel, quantity and revenue of every line."""
    lines = sales(spark, sf, "inv_date", "item_code", "region", "quantity", "usd_total", *extra)
    return lines.withColumnsRenamed(
        {"inv_date": "sale_date", "item_code": "sku", "region": "channel", "usd_total": "revenue"}
    )


def money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: double(c) for c in columns})


def quarterly(spark: SparkSession, sf: str) -> DataFrame:
    """Totals by customer and type, which do not buy in every quarter."""
    lines = sales(spark, sf, "inv_date", "customer", "type", "usd_total")
    return periodic.quarterly_totals(lines, "usd_total", ("customer", "type"), "inv_date")


def views(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = sales(spark, sf, "inv_date", "type", "usd_total")
    return periodic.quarterly_views(lines, "usd_total", "type", FOCUS_TYPES, ("type",), "inv_date")


def split_latest_quarter(spark: SparkSession, sf: str) -> DataFrame:
    train, test, latest = periodic.split_latest(quarterly(spark, sf))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.select("customer", "type", "sale_quarter", "quarter_total", "part", latest.alias("latest"))


def densify_quarters(spark: SparkSession, sf: str) -> DataFrame:
    """Quarterly quantity per customer, who does not buy in every quarter."""
    lines = sales(spark, sf, "inv_date", "customer", "quantity")
    return periodic.quarterly_totals(lines, "quantity", ("customer",), "inv_date").select(
        "customer", "sale_quarter", "quarter_total"
    )


def densify_months(spark: SparkSession, sf: str) -> DataFrame:
    rows = sales(spark, sf, "inv_date", "customer", "quantity")
    monthly = rows.groupBy("customer", F.last_day("inv_date").alias("sale_month")).agg(F.sum("quantity").alias("quantity"))
    return money(periodic.fill_month_gaps(monthly, ("quantity",), ("customer",)), "quantity")


def monthly_series(spark: SparkSession, sf: str) -> DataFrame:
    """The focus cohort as one monthly series."""
    lines = sales(spark, sf, "inv_date", "code", "quantity", "usd_total")
    cohort = lines.filter(F.col("code").startswith(FOCUS)).withColumnsRenamed(
        {"inv_date": "sale_date", "usd_total": "revenue"}
    )
    return money(periodic.monthly_series(cohort), "quantity", "revenue")


def holdout_split(spark: SparkSession, sf: str) -> DataFrame:
    monthly = periodic.monthly_history(history(spark, sf), ("channel",))
    return money(periodic.label_holdout(monthly, "sale_month", CUTOFF), "quantity", "revenue")


def sales_history(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_sales(spark, sf).select("InvDate", "ItemCode", "Product", "source_sheet", "Quantity", "Total")
    return readers.history_from_clean(raw)


def alias_sheets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Three sources with different headers; the last has no date and is left out."""
    line = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    return {
        "im_lines": line.select(
            F.date_format("l_shipdate", "yyyy/MM").alias("Month"), F.col("l_partkey").cast("string").alias("Sku"),
            (F.col("l_quantity") - 5).alias("Received Qty"),
        ),
        "orders_history": orders.select(
            F.col("o_orderdate").cast("date").cast("string").alias("Date"), F.col("o_orderpriority").alias("Product"),
            F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise("1").alias("Qty"), F.col("o_totalprice").alias("Total"),
        ),
        "undated": table(spark, sf, "supplier").select(F.col("s_name").alias("SKU"), F.col("s_acctbal").alias("Qty")),
    }


def history_folder(spark: SparkSession, sf: str) -> DataFrame:
    """The history of a folder of CSV files: one per ship month under one header, one per order year under another, one unusable."""
    folder = f"{work_dir(spark)}/history-{uuid.uuid4().hex}"
    lines = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy/MM").alias("Month"), F.col("l_partkey").alias("Sku"), (F.col("l_quantity") - 5).alias("Received Qty"),
        F.date_format("l_shipdate", "'im_'yyyyMM").alias("sheet"),
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").cast("string").alias("Date"), F.col("o_orderpriority").alias("Product"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("Total"), F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise("1").alias("Qty"),
        F.date_format("o_orderdate", "'orders_'yyyy").alias("sheet"),
    )
    undated = table(spark, sf, "supplier").select(F.col("s_name").alias("SKU"), F.col("s_acctbal").alias("Qty"), F.lit("undated").alias("sheet"))
    for sheet in (lines, orders, undated):
        sheet.write.mode("append").partitionBy("sheet").option("header", True).csv(folder)
    return readers.load_history(spark, None, folder)


def monthly_actuals(spark: SparkSession, sf: str) -> DataFrame:
    lines = sales(spark, sf, "inv_date", "item_code", "quantity", "usd_total", "product", "type", "code")
    named = {"product_name": "product", "product_type": "type", "product_subcategory": "code"}
    actuals = periodic.monthly_actuals(lines.withColumnRenamed("item_code", "sku"), named)
    return money(actuals, "actual_quantity", "actual_revenue")


def product_price(spark: SparkSession, sf: str) -> DataFrame:
    """Mean unit price per product, from an exact sum."""
    rows = sales(spark, sf, "product", "usd_price")
    total, n = F.sum("usd_price").cast("double"), F.count("usd_price")
    return rows.groupBy("product").agg((total / n).alias("avg_price"))


def grouped_months(*keys: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = sales(spark, sf, "inv_date", "quantity", "usd_total", *keys)
        out = rows.groupBy(*keys, F.last_day("inv_date").alias("sale_month")).agg(
            F.sum("quantity").alias("quantity"), F.sum("usd_total").alias("revenue")
        )
        return money(out, "quantity", "revenue")

    return query


def target_list(spark: SparkSession, sf: str) -> DataFrame:
    """Skus of chosen types sold in chosen regions within a date range."""
    rows = sales(spark, sf, "inv_date", "region", "item_code", "type")
    chosen = dates_between(rows, "inv_date", "1997-01-01", "1997-06-30").filter(
        F.col("type").isin(*FOCUS_TYPES) & F.col("region").isin("ASIA", "EUROPE")
    )
    return chosen.groupBy(F.col("item_code").alias("sku")).agg(F.count("*").alias("sales"))


def missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Products and the years in which they were not sold, over all products and years."""
    sold = sales(spark, sf, "part_id", "inv_date").select("part_id", F.year("inv_date").alias("year")).distinct()
    years = table(spark, sf, "orders").agg(F.sequence(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).alias("years"))
    wanted = table(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), years.scalar().alias("years"))
    return wanted.select("part_id", F.explode("years").alias("year")).join(sold, ["part_id", "year"], "left_anti")


QUERIES = {
    "sales_history": sales_history,
    "history_folder": history_folder,
    "history_alias_union": lambda s, d: readers.history_from_sheets(alias_sheets(s, d)),
    "monthly_history": lambda s, d: money(periodic.monthly_history(history(s, d)), "quantity", "revenue"),
    "monthly_series": monthly_series,
    "monthly_actuals": monthly_actuals,
    "quarterly_dataset": quarterly,
    "quarterly_global": lambda s, d: views(s, d)[0],
    "quarterly_focus": lambda s, d: views(s, d)[1],
    "densify_quarters": densify_quarters,
    "densify_months": densify_months,
    "split_latest_quarter": split_latest_quarter,
    "holdout_split": holdout_split,
    "focus_flag": lambda s, d: periodic.tag_focus(
        table(s, d, "part").select("p_partkey", "p_type"), "p_type", FOCUS_TYPES
    ),
    "product_monthly": grouped_months("product"),
    "subcat_monthly": grouped_months("code"),
    "product_price": product_price,
    "target_list": target_list,
    "missing_keys": missing_keys,
}


def _sales(body: str) -> str:
    """``body`` over the sales views; a leading comma adds views of its own."""
    return f"WITH {SALES_SQL}{body}" if body.startswith(",") else f"WITH {SALES_SQL}\n{body}"


_MEASURES = "CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(sum(usd_total) AS DOUBLE) AS revenue"


def _quarters(source: str, value: str, segments: list[str]) -> str:
    """Observed combinations and all quarters, left joined with the totals."""
    keys = ", ".join(segments)
    levels = f"(SELECT DISTINCT {keys} FROM totals)"
    return f"""totals AS (SELECT {keys}, CAST(date_trunc('quarter', inv_date) AS DATE) AS sale_quarter, sum({value}) AS v
      FROM {source} GROUP BY ALL),
    grid AS (SELECT * FROM {levels} CROSS JOIN (
      SELECT CAST(unnest(generate_series(min(sale_quarter), max(sale_quarter), INTERVAL 3 MONTH)) AS DATE) AS sale_quarter FROM totals)),
    filled AS (SELECT {keys}, sale_quarter, coalesce(CAST(v AS DOUBLE), 0) AS quarter_total, sale_quarter AS quarter_start,
      CAST(sale_quarter + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end
      FROM grid LEFT JOIN totals USING ({keys}, sale_quarter))"""


_TAGGED = "tagged AS (SELECT *, type IN ('PROMO', 'ECONOMY') AS is_focus_product FROM usd)"
_DATED = date_sql('"InvDate"')

ORACLES = {
    "sales_history": f"""WITH {RAW_SQL} SELECT {_DATED} AS sale_date,
        coalesce({_strip('"ItemCode"')}, {_strip('"Product"')}, 'UNSPECIFIED') AS sku, trim(source_sheet) AS channel,
        coalesce(TRY_CAST("Quantity" AS DOUBLE), 0) AS quantity, coalesce(TRY_CAST("Total" AS DOUBLE), 0) AS revenue
        FROM raw WHERE {_DATED} IS NOT NULL""",
    "history_folder": """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS sale_date, CAST(l_partkey AS VARCHAR) AS sku,
        'IM' AS channel, greatest(l_quantity - 5, 0) AS quantity, CAST(0 AS DOUBLE) AS revenue FROM lineitem
        UNION ALL SELECT CAST(o_orderdate AS DATE), o_orderpriority, 'TDBS', CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1 END,
        CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) FROM orders""",
    "history_alias_union": """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS sale_date, CAST(l_partkey AS VARCHAR) AS sku,
        'IM' AS channel, greatest(l_quantity - 5, 0) AS quantity, CAST(0 AS DOUBLE) AS revenue FROM lineitem
        UNION ALL SELECT CAST(o_orderdate AS DATE), o_orderpriority, 'TDBS', CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1 END,
        o_totalprice FROM orders""",
    "monthly_history": _sales(f"SELECT item_code AS sku, region AS channel, last_day(inv_date) AS sale_month, {_MEASURES} FROM usd GROUP BY ALL"),
    "monthly_series": _sales(
        f"""SELECT sale_month, coalesce(quantity, 0) AS quantity, coalesce(revenue, 0) AS revenue FROM (
        SELECT last_day(CAST(unnest(generate_series(CAST(date_trunc('month', min(inv_date)) AS DATE), max(inv_date), INTERVAL 1 MONTH)) AS DATE)) AS sale_month
        FROM usd WHERE starts_with(code, '{FOCUS}')) LEFT JOIN (
        SELECT last_day(inv_date) AS sale_month, {_MEASURES} FROM usd WHERE starts_with(code, '{FOCUS}') GROUP BY 1) USING (sale_month)"""
    ),
    "monthly_actuals": _sales(
        """SELECT last_day(inv_date) AS sale_month, item_code AS sku, CAST(sum(quantity) AS DOUBLE) AS actual_quantity,
        CAST(sum(usd_total) AS DOUBLE) AS actual_revenue, min(product) AS product_name, min(type) AS product_type,
        min(code) AS product_subcategory FROM usd GROUP BY 1, 2"""
    ),
    "quarterly_dataset": _sales(f", {_quarters('usd', 'usd_total', ['customer', 'type'])} SELECT * FROM filled"),
    "quarterly_global": _sales(f", {_TAGGED}, {_quarters('tagged', 'usd_total', ['type', 'is_focus_product'])} SELECT * FROM filled"),
    "quarterly_focus": _sales(
        f""", {_TAGGED}, focus AS (SELECT * FROM tagged WHERE is_focus_product),
        {_quarters('focus', 'usd_total', ['type', 'is_focus_product'])} SELECT * FROM filled"""
    ),
    "densify_quarters": _sales(
        f""", {_quarters('sales', 'quantity', ['customer'])} SELECT customer, sale_quarter, quarter_total FROM filled"""
    ),
    "densify_months": _sales(
        """, kept AS (SELECT customer, last_day(inv_date) AS sale_month, CAST(sum(quantity) AS DOUBLE) AS quantity FROM sales
        GROUP BY ALL), spine AS (SELECT customer, last_day(CAST(unnest(generate_series(CAST(date_trunc('month', min(sale_month)) AS DATE), max(sale_month), INTERVAL 1 MONTH)) AS DATE)) AS sale_month
        FROM kept GROUP BY customer) SELECT customer, sale_month, coalesce(quantity, 0) AS quantity
        FROM spine LEFT JOIN kept USING (customer, sale_month)"""
    ),
    "split_latest_quarter": _sales(
        f""", {_quarters('usd', 'usd_total', ['customer', 'type'])} SELECT customer, type, sale_quarter, quarter_total,
        CASE WHEN sale_quarter = (SELECT max(sale_quarter) FROM filled) THEN 'test' ELSE 'train' END AS part,
        (SELECT max(sale_quarter) FROM filled) AS latest FROM filled"""
    ),
    "holdout_split": _sales(
        f"""SELECT region AS channel, last_day(inv_date) AS sale_month, {_MEASURES},
        CASE WHEN last_day(inv_date) < DATE '{CUTOFF}' THEN 'history' ELSE 'holdout' END AS part FROM usd GROUP BY ALL"""
    ),
    "focus_flag": "SELECT p_partkey, p_type, p_type IN ('PROMO', 'ECONOMY') AS is_focus_product FROM part",
    "product_monthly": _sales(f"SELECT product, last_day(inv_date) AS sale_month, {_MEASURES} FROM usd GROUP BY ALL"),
    "subcat_monthly": _sales(f"SELECT code, last_day(inv_date) AS sale_month, {_MEASURES} FROM usd GROUP BY ALL"),
    "product_price": _sales("SELECT product, CAST(sum(usd_price) AS DOUBLE) / count(usd_price) AS avg_price FROM usd GROUP BY product"),
    "target_list": _sales(
        """SELECT item_code AS sku, count(*) AS sales FROM sales WHERE inv_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'
        AND type IN ('PROMO', 'ECONOMY') AND region IN ('ASIA', 'EUROPE') GROUP BY 1"""
    ),
    "missing_keys": """SELECT p_partkey AS part_id, year FROM part,
        (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS year FROM orders)
        WHERE (p_partkey, year) NOT IN (SELECT l_partkey, year(o_orderdate) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
}
