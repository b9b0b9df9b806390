"""The test tables seen as sales lines.

``sales`` joins only what the requested columns need, smallest side first:
orders meet customers before the lines meet orders, and product attributes are
derived on the part table, once per product, before the lines meet it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.numbers import exchange_rate

PREFIX = "SUB-"
FOCUS = "RACK-"

# Names the product column cycles through; the size is appended. One for every
# keyword of the family rules, and some of no family.
PRODUCT_NAMES = (
    *[f"{words.replace('&', ' ')} " for _, options in fixed.FAMILY_RULES for words in options],
    "shelf ",
    "cable ",
    "fan ",
)

LINE = ("order_id", "part_id", "line_no", "supplier_id", "item_code", "quantity", "total", "price", "ship_date")
ORDER = ("inv_date", "source_sheet")
CUSTOMER = ("customer", "segment")
NATION = ("country",)
REGION = ("region", "currency")
USD = ("usd_total", "usd_price")
PART = ("product", "type", "code", "size", "family", "service_family", "capacity_band", "plan_variant")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a name, a type and a code such as ``SUB-PROMO-M-Brand#7``."""
    names = F.array(*[F.lit(n) for n in PRODUCT_NAMES])
    index = (F.col("p_partkey") % len(PRODUCT_NAMES) + 1).cast("int")
    band = F.when(F.col("p_size") <= 15, "S").when(F.col("p_size") <= 35, "M").otherwise("L")
    prefix = F.when(F.col("p_size") % 5 == 0, FOCUS).otherwise(PREFIX)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.concat(F.element_at(names, index), F.col("p_size").cast("string")).alias("product"),
        F.col("p_type").alias("type"),
        F.concat(prefix, F.concat_ws("-", "p_type", band, "p_brand")).alias("code"),
        F.col("p_size").alias("size"),
    )


def region_currency(region: Column) -> Column:
    """One currency per region: an unlisted one and a missing one among them."""
    return (
        F.when(region == "AMERICA", "USD")
        .when(region == "EUROPE", "EUR")
        .when(region == "ASIA", "JPY")
        .when(region == "AFRICA", "ZAR")
    )


def geography(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_name", "country")
    if wanted.isdisjoint(REGION):
        return nation.select("n_nationkey", "country")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_name", "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select("n_nationkey", "country", "region", region_currency(F.col("region")).alias("currency"))


def customers(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_name": "customer", "c_mktsegment": "segment"}
    )
    if not wanted.isdisjoint({*NATION, *REGION}):
        places = geography(spark, sf_dir, wanted)
        customer = customer.join(places, customer.c_nationkey == places.n_nationkey)
    return customer


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = F.col("l_extendedprice").cast("decimal(12,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supplier_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("item_code"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        money.alias("total"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100)
        .cast("decimal(12,2)")
        .alias("price"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )


def sales(
    spark: SparkSession, sf_dir: str, *columns: str, products: DataFrame | None = None
) -> DataFrame:
    """Sales lines with exactly ``columns``, joining only the tables they need.

    ``products`` replaces the product dimension, for example by a filtered one. It meets the lines
    first: what it drops is not shuffled, and the lines stay where the join with their orders puts them.
    """
    wanted = set(columns)
    if not wanted.isdisjoint(USD):
        wanted |= {"currency", "total", "price"}
    df = lines(spark, sf_dir)
    if products is not None and not wanted.isdisjoint(PART):
        df = df.join(products, "part_id")
    if not wanted.isdisjoint({*ORDER, *CUSTOMER, *NATION, *REGION}):
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            "o_custkey",
            F.col("o_orderdate").cast("date").alias("inv_date"),
            F.year("o_orderdate").cast("string").alias("source_sheet"),
        )
        if not wanted.isdisjoint({*CUSTOMER, *NATION, *REGION}):
            buyer = customers(spark, sf_dir, wanted)
            orders = orders.join(buyer, orders.o_custkey == buyer.c_custkey)
        # Lines and orders both grow with the data: never broadcast either of them.
        df = df.hint("merge").join(orders, "order_id")
    if products is None and not wanted.isdisjoint(PART):
        df = df.join(parts(spark, sf_dir), "part_id")
    if not wanted.isdisjoint(USD):
        rate = exchange_rate(F.col("currency"))
        df = df.withColumns({"usd_total": F.col("total") * rate, "usd_price": F.col("price") * rate})
    return df.select(*columns)


def dates_between(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    return df.filter(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


# --- the same views for the SQL oracle ---------------------------------------------

_NAMES = ", ".join(f"'{n}'" for n in PRODUCT_NAMES)

SALES_SQL = f"""
sales AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS part_id, l.l_linenumber AS line_no,
         l.l_suppkey AS supplier_id, 'P' || l.l_partkey AS item_code,
         CAST(l.l_quantity AS DECIMAL(12,2)) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS total,
         CAST(floor(l.l_extendedprice / l.l_quantity * 100) / 100 AS DECIMAL(12,2)) AS price,
         CAST(l.l_shipdate AS DATE) AS ship_date, CAST(o.o_orderdate AS DATE) AS inv_date,
         CAST(year(o.o_orderdate) AS VARCHAR) AS source_sheet, c.c_name AS customer,
         c.c_mktsegment AS segment, n.n_name AS country, r.r_name AS region,
         CASE r.r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' WHEN 'ASIA' THEN 'JPY'
                       WHEN 'AFRICA' THEN 'ZAR' END AS currency,
         CAST(CASE r.r_name WHEN 'AMERICA' THEN 1.00 WHEN 'EUROPE' THEN 1.05 WHEN 'ASIA' THEN 0.0067
                       ELSE (0.63 + 1.05 + 0.0067 + 0.031 + 1.00) / 5 END AS DECIMAL(8,5)) AS rate,
         ([{_NAMES}])[p.p_partkey % {len(PRODUCT_NAMES)} + 1] || p.p_size AS product,
         p.p_type AS type, p.p_size AS size,
         CASE WHEN p.p_size % 5 = 0 THEN '{FOCUS}' ELSE '{PREFIX}' END || p.p_type || '-' ||
         CASE WHEN p.p_size <= 15 THEN 'S' WHEN p.p_size <= 35 THEN 'M' ELSE 'L' END || '-' || p.p_brand AS code
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON l.l_partkey = p.p_partkey
),
usd AS (SELECT *, total * rate AS usd_total, price * rate AS usd_price FROM sales)"""
