"""Registered queries: sources, cleaning, classification, enrichment, staging."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import numbers, periods, rules, text
from ..operators import clean, enrich, staging
from ..session import work_dir
from ..sources import readers
from .views import SALES_SQL, geography, sales, table

KEYS = ("order_id", "part_id", "line_no", "supplier_id")

def _rule_names() -> list[tuple[str, str]]:
    """A start and an end of a name for every classification rule."""
    rules_in_order = (*fixed.CATEGORY_RULES, *fixed.SUBCATEGORY_RULES)
    pairs = [("".join(r.starts[:1]), "".join(r.contains[:1]).replace("&", " ")) for r in rules_in_order]
    return [p for p in pairs if any(p)]


def _service_names() -> list[tuple[str, str]]:
    plans = [token for token, _ in fixed.SERVICE_PLANS]
    sizes = [*fixed.SERVICE_CAPACITIES, ""]
    return [
        (f"{fixed.SERVICE_MARK} {kind} {size} {plan} ", "")
        for kind, size, plan in zip(fixed.SERVICE_TYPES, sizes, plans)
    ]


# Name patterns for the raw product column; the size goes between the halves.
RAW_NAMES = (
    *_rule_names(),
    *_service_names(),
    (fixed.DRIVE[0], "-8T"),
    (fixed.DRIVE[1], "-16T (bulk)"),
    (fixed.DRIVE[2], "-800G"),
    (f"(promo) {fixed.SERVER[0]}", "+"),
    (f"{fixed.SERVER[3]}60", ""),
    (fixed.OTHER_NAMES[2][:-1], ""),
    ("Panel ", ""),
    ("NULLABLE ", ""),
    ("   ", "   "),
)


def raw_product() -> Column:
    heads = F.array(*[F.lit(a) for a, _ in RAW_NAMES])
    tails = F.array(*[F.lit(b) for _, b in RAW_NAMES])
    index = (F.col("part_id") % len(RAW_NAMES) + 1).cast("int")
    size = F.when(F.element_at(heads, index) == "   ", "").otherwise(F.col("size").cast("string"))
    return F.concat(F.element_at(heads, index), size, F.element_at(tails, index))


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales lines as untyped text, with the dirt a hand-kept workbook has."""
    needed = ("inv_date", "ship_date", "quantity", "total", "price", "customer", "country",
              "region", "currency", "item_code", "source_sheet")
    lines = sales(spark, sf, *KEYS, *needed).join(products(spark, sf), "part_id")
    order, part = F.col("order_id"), F.col("part_id")

    def words(c: str) -> Column:
        return F.col(c).cast("string")

    return lines.select(
        *KEYS,
        F.concat(F.lit("PI"), words("order_id")).alias("PI"),
        F.when(order % 97 == 0, "NULL").when(order % 89 == 0, "  ")
        .when(order % 83 == 0, F.concat(F.lit("  "), "customer", F.lit(" ")))
        .when(order % 79 == 0, F.concat(F.lit("\u2003"), "customer", F.lit("\xa0"))).otherwise(F.col("customer")).alias("Customer"),
        F.when(part % 13 == 0, None).when(part % 17 == 0, "null").when(part % 19 == 0, "\xa0")
        .otherwise(F.col("item_code")).alias("ItemCode"),
        F.col("product").alias("Product"),
        F.when((order % 11 == 0) & (F.col("line_no") == 7), "-3").when(order % 53 == 0, "n/a")
        .otherwise(words("quantity")).alias("Quantity"),
        words("price").alias("Price"),
        F.when(order % 101 == 0, "-1.50").when(order % 103 == 0, "oops").when(order % 113 == 0, "12.345675")
        .otherwise(words("total")).alias("Total"),
        F.col("currency").alias("Currency"),
        F.when(order % 107 == 0, "2024-13-45").when(order % 109 == 0, "soon")
        .when(order % 59 == 0, F.date_format("inv_date", "yyyy/MM/dd")).when(order % 61 == 0, F.date_format("inv_date", "MM/dd/yyyy"))
        .when(order % 67 == 0, F.date_format("inv_date", "dd-MMM-yyyy")).otherwise(words("inv_date")).alias("InvDate"),
        words("ship_date").alias("ShipDate"),
        F.when(order % 3 == 0, None).otherwise(F.col("country")).alias("ShipTo"),
        F.col("country").alias("Country"),
        F.when(order % 5 == 0, None).otherwise(F.col("region")).alias("Region"),
        F.lit("note").alias("Comments"),
        F.lit("pcs").alias("Unit"),
        "source_sheet",
    )


def country_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Country to region; the region of some countries is unknown."""
    region = F.when(F.col("n_nationkey") % 6 != 0, F.col("region"))
    return geography(spark, sf, {"region"}).select(F.col("country").alias("Country"), region.alias("Region"))


def bays_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Bays per product: a distinct list of names with a number each."""
    names = table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_id"), F.col("p_size").alias("size")
    )
    named = names.select(raw_product().alias("Product"), "size")
    return named.groupBy("Product").agg((F.max("size") % 12 + 1).alias("Bays"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_id"), F.col("p_size").alias("size")
    ).select("part_id", raw_product().alias("product"))


def money(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("double") for n in names}


# --- queries -----------------------------------------------------------------------------


def sheets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "orders": table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status")
        ),
        "events": table(spark, sf, "events").select(
            F.col("event_id").alias("id"), F.col("value").alias("total"), F.col("user_id").alias("user")
        ),
        "suppliers": table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("total"), F.col("s_name").alias("name")
        ),
    }


def sheet_names(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sheet names and their arrival order; several sanitise to one token."""
    gap = F.when(F.col("p_size") % 3 == 0, " ").when(F.col("p_size") % 3 == 1, "!").otherwise("__")
    raw = F.concat(F.col("p_type"), gap, F.col("p_brand"), F.when(F.col("p_size") < 10, " ").otherwise(""))
    return table(spark, sf, "part").groupBy(raw.alias("raw")).agg(F.min("p_partkey").alias("position"))


def dedupe_names(spark: SparkSession, sf: str) -> DataFrame:
    """A number for every repeat of a token. One row per sheet, so groups are short."""
    named = sheet_names(spark, sf).withColumn("token", text.sheet_token(F.col("raw")))
    nth = F.row_number().over(Window.partitionBy("token").orderBy("position", "raw"))
    suffix = F.when(F.col("nth") > 1, F.concat(F.lit("_"), F.col("nth").cast("string"))).otherwise("")
    return named.withColumn("nth", nth).select("raw", F.concat("token", suffix).alias("name"))


def clean_sales(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean.clean_sales(
        raw_sales(spark, sf), country_regions=country_lookup(spark, sf), device_bays=bays_lookup(spark, sf)
    )
    columns = [*KEYS, *fixed.EXPORT_COLUMNS, "ShipTo", "ShipDate", "Currency", "Capacity", "total_cap", "Bays", "total_bays"]
    return cleaned.select(*columns).withColumns(money("usd_adjusted_price", "usd_adjusted_total"))


def classify_subcategory(spark: SparkSession, sf: str) -> DataFrame:
    return clean.classify(products(spark, sf), "product", "category", "subcategory")


def fx_convert(spark: SparkSession, sf: str) -> DataFrame:
    lines = sales(spark, sf, *KEYS, "currency", "price", "total")
    out = enrich.convert_currency(lines, "currency", "price", "total")
    return out.select(*KEYS, "currency", *money("exchange_rate_to_usd", "usd_adjusted_price", "usd_adjusted_total").values())


def drive_capacity(spark: SparkSession, sf: str) -> DataFrame:
    typed = clean.classify(products(spark, sf).withColumnRenamed("product", "Product")).drop("sub_cat")
    lines = sales(spark, sf, *KEYS, "quantity").join(enrich.drive_capacity(typed), "part_id")
    sized = enrich.total_capacity(lines, quantity="quantity")
    return sized.select(*KEYS, "Product", "Capacity", "Unit", F.col("total_cap").cast("double").alias("total_cap"))


SUITES = {"suite_a": ("1995", "1996"), "suite_b": ("1997", "1998")}


def staged(spark: SparkSession, sf: str, suite: str | None = None) -> DataFrame:
    rows = staging.stage_sales(raw_sales(spark, sf), SUITES[suite] if suite else None)
    return rows.withColumns(money("quantity", "revenue"))


def fill_mode(spark: SparkSession, sf: str) -> DataFrame:
    return clean.fill_mode(sales(spark, sf, *KEYS, "currency"), "currency")


def fill_group_mode(spark: SparkSession, sf: str) -> DataFrame:
    gaps = F.when((F.col("order_id") % 5 != 0) & (F.col("order_id") % 7 != 0), F.col("region"))
    lines = sales(spark, sf, *KEYS, "country", "region").withColumn("region", gaps)
    return clean.fill_group_mode(lines, "country", "region")


def fill_mean(spark: SparkSession, sf: str) -> DataFrame:
    gaps = F.when(F.col("order_id") % 10 != 0, F.col("price"))
    lines = sales(spark, sf, *KEYS, "price").withColumn("price", gaps)
    return clean.fill_mean(lines, "price").withColumn("price", F.round("price", 6))


def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.coerce_numbers(raw_sales(spark, sf).select(*KEYS, *fixed.NUMERIC_COLUMNS))
    return rows


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        periods.month_start(day).alias("month"),
        periods.month_end(day).alias("month_end"),
        periods.quarter_start(day).alias("quarter_start"),
        periods.quarter_end(day).alias("quarter_end"),
        F.quarter(day).alias("quarter"),
        periods.fiscal_year(day, 4).alias("fiscal_year"),
    )


def sheet_folder(spark: SparkSession, sf: str) -> str:
    """A folder with a CSV sheet per market segment and one per supplier country, under two headers."""
    folder = f"{work_dir(spark)}/sheets-{uuid.uuid4().hex}"
    amount = "decimal(12,2)"
    accounts = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").cast(amount).alias("balance"), F.col("c_mktsegment").alias("sheet")
    )
    vendors = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").cast(amount).alias("total"),
        F.concat(F.lit("vendors+"), F.col("s_nationkey").cast("string")).alias("sheet"),
    )
    for sheet in (accounts, vendors):
        sheet.write.mode("append").partitionBy("sheet").option("header", True).csv(folder)
    return folder


QUERIES = {
    "scan_sheet_folder": lambda s, d: readers.read_sheets(s, sheet_folder(s, d)),
    "scan_union_by_name": lambda s, d: readers.union_sheets(sheets(s, d)),
    "scan_select_sheets": lambda s, d: readers.union_sheets(sheets(s, d), ["suppliers", "orders"]),
    "sanitize_names": lambda s, d: sheet_names(s, d).select("raw", text.sheet_token(F.col("raw")).alias("token")),
    "dedupe_names": dedupe_names,
    "normalise_nulls": lambda s, d: clean.normalise_missing(
        raw_sales(s, d).select(*KEYS, "Customer", "ItemCode", "Product", "Country", "ShipTo")
    ),
    "coerce_numeric": coerce_numeric,
    "clean_sales": clean_sales,
    "strip_prefix": lambda s, d: products(s, d).withColumn(
        "product", text.drop_leading_parenthesis(F.col("product"))
    ),
    "classify_category": lambda s, d: clean.classify(products(s, d), "product", "category", "_sub").drop("_sub"),
    "classify_subcategory": classify_subcategory,
    "service_code": lambda s, d: products(s, d)
    .withColumn("_name", rules.normalised(F.col("product")))
    .withColumn("code", rules.service_code("_name"))
    .drop("_name"),
    "drive_capacity": drive_capacity,
    "service_family": lambda s, d: products(s, d).withColumn("family", text.service_family(F.col("product"))),
    "parse_code": lambda s, d: sales(s, d, *KEYS, "code").select(
        *KEYS, *[text.code_part(F.col("code"), n).alias(f"part_{n}") for n in (2, 3, 4, 5)]
    ),
    "fx_convert": fx_convert,
    "country_region": lambda s, d: enrich.map_region(
        sales(s, d, *KEYS, "country").withColumnRenamed("country", "Country"), country_lookup(s, d)
    ),
    "device_bays": lambda s, d: enrich.attach_bays(
        sales(s, d, *KEYS, "quantity").join(products(s, d).withColumnRenamed("product", "Product"), "part_id"),
        bays_lookup(s, d), quantity="quantity",
    ).withColumns(money("quantity", "total_bays")),
    "fill_mode": fill_mode,
    "fill_group_mode": fill_group_mode,
    "fill_mean": fill_mean,
    "staging_sales": staged,
    "staging_suite_a": lambda s, d: staged(s, d, "suite_a"),
    "staging_suite_b": lambda s, d: staged(s, d, "suite_b"),
    "suite_split": lambda s, d: staging.split_suites(sales(s, d, *KEYS, "source_sheet"), SUITES),
    "standardise_text": lambda s, d: table(s, d, "part").select(
        "p_partkey", text.standardise(F.concat(F.lit(" \t"), "p_name", F.lit(" "), "p_brand", F.lit("\n"))).alias("sku")
    ),
    "calendar_features": calendar_features,
    "clip_nonneg": lambda s, d: table(s, d, "customer").select(
        "c_custkey",
        numbers.clip_negative(F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal") - 5000)).alias("balance"),
    ),
}

# --- oracles ---------------------------------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_INDEX = f"part_id % {len(RAW_NAMES)} + 1"
_HEAD, _TAIL = (f"{_list(r[i] for r in RAW_NAMES)}[{_INDEX}]" for i in (0, 1))
RAW_PRODUCT_SQL = f"{_HEAD} || CASE WHEN {_HEAD} = '   ' THEN '' ELSE CAST(size AS VARCHAR) END || {_TAIL}"
_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160) || chr(8195)"


def date_sql(c: str) -> str:
    iso = f"CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST({c} AS DATE) END"
    return f"coalesce({iso}, CAST(try_strptime({c}, ['%Y/%m/%d', '%m/%d/%Y', '%d-%b-%Y']) AS DATE))"


def _strip(c: str) -> str:
    return f"trim({c}, {_WS})"


_K = ", ".join(KEYS)

RAW_SQL = f"""{SALES_SQL},
raw AS (
  SELECT {_K}, 'PI' || order_id AS "PI",
         CASE WHEN order_id % 97 = 0 THEN 'NULL' WHEN order_id % 89 = 0 THEN '  '
              WHEN order_id % 83 = 0 THEN '  ' || customer || ' '
              WHEN order_id % 79 = 0 THEN chr(8195) || customer || chr(160) ELSE customer END AS "Customer",
         CASE WHEN part_id % 13 = 0 THEN NULL WHEN part_id % 17 = 0 THEN 'null' WHEN part_id % 19 = 0 THEN chr(160)
              ELSE item_code END AS "ItemCode",
         {RAW_PRODUCT_SQL} AS "Product",
         CASE WHEN order_id % 11 = 0 AND line_no = 7 THEN '-3' WHEN order_id % 53 = 0 THEN 'n/a'
              ELSE CAST(quantity AS VARCHAR) END AS "Quantity",
         CAST(price AS VARCHAR) AS "Price",
         CASE WHEN order_id % 101 = 0 THEN '-1.50' WHEN order_id % 103 = 0 THEN 'oops'
              WHEN order_id % 113 = 0 THEN '12.345675' ELSE CAST(total AS VARCHAR) END AS "Total",
         currency AS "Currency",
         CASE WHEN order_id % 107 = 0 THEN '2024-13-45' WHEN order_id % 109 = 0 THEN 'soon'
              WHEN order_id % 59 = 0 THEN strftime(inv_date, '%Y/%m/%d') WHEN order_id % 61 = 0 THEN strftime(inv_date, '%m/%d/%Y')
              WHEN order_id % 67 = 0 THEN strftime(inv_date, '%d-%b-%Y') ELSE CAST(inv_date AS VARCHAR) END AS "InvDate",
         CAST(ship_date AS VARCHAR) AS "ShipDate", CASE WHEN order_id % 3 = 0 THEN NULL ELSE country END AS "ShipTo",
         country AS "Country", CASE WHEN order_id % 5 = 0 THEN NULL ELSE region END AS "Region", source_sheet
  FROM sales
)"""


def _rule_case(table_of_rules, name: str, category: str | None = None) -> str:
    """The rule tables as one CASE over ``name``."""
    parts = []
    for rule in table_of_rules:
        starts = " OR ".join(f"starts_with({name}, '{s}')" for s in rule.starts)
        contains = " OR ".join(
            "(" + " AND ".join(f"contains({name}, '{w}')" for w in c.split("&")) + ")" for c in rule.contains
        )
        both = [f"({x})" for x in (starts, contains) if x]
        test = (" AND " if rule.both else " OR ").join(both)
        if rule.category:
            test = f"{category} = '{rule.category}' AND ({test})"
        parts.append(f"WHEN {test} THEN '{rule.label}'")
    return "\n".join(parts)


def category_sql(product: str) -> str:
    name = f"upper({_strip(product)})"
    rows = _rule_case(fixed.CATEGORY_RULES, name)
    return f"CASE WHEN {product} IS NULL OR {name} = '' THEN 'Other' {rows} ELSE 'Other' END"


def _first_token(tokens, name: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({name}, '{t}') THEN '{v}'" for t, v in tokens) + " ELSE 'UNKNOWN' END"


def service_code_sql(product: str) -> str:
    name = f"upper({_strip(product)})"
    parts = [
        _first_token([(t, t) for t in fixed.SERVICE_TYPES], name),
        _first_token([(t, t) for t in fixed.SERVICE_CAPACITIES], name),
        _first_token(fixed.SERVICE_PLANS, name),
    ]
    return "'C2-' || " + " || '-' || ".join(parts)


def subcategory_sql(product: str, category: str) -> str:
    name = f"lower({_strip(product)})"
    others = ", ".join(f"'{n}'" for n in fixed.OTHER_NAMES)
    rows = _rule_case(fixed.SUBCATEGORY_RULES, name, category)
    return f"""CASE WHEN {product} IS NULL OR {name} = '' THEN '' WHEN {name} IN ({others}) THEN 'Other' {rows}
      WHEN {category} IN ('C2-SAAS', 'C2-HYBRID') AND contains(upper({name}), 'C2') THEN {service_code_sql(product)}
      ELSE '' END"""


def capacity_sql(product: str, category: str) -> str:
    return f"""CASE WHEN {category} = 'DRIVE' AND regexp_full_match({product}, '[A-Z0-9]+-[0-9]+[GT](\\s*\\(.*\\))?')
      THEN CAST(regexp_extract({product}, '^[^-]*-(\\d+)', 1) AS BIGINT)
        * CASE WHEN ends_with({product}, 'T') THEN 1000 ELSE 1 END END"""


def _nulls(c: str, trim: bool = True) -> str:
    cell = f"CASE WHEN {_strip(c)} = '' OR contains({c}, 'NULL') OR contains({c}, 'null') THEN NULL ELSE {c} END"
    return _strip(f"({cell})") if trim else cell


_PRODUCTS = f"WITH products AS (SELECT part_id, {RAW_PRODUCT_SQL} AS product FROM (SELECT p_partkey AS part_id, p_size AS size FROM part))"

_SHEETS = {
    "orders": "SELECT o_orderkey AS id, o_totalprice AS total, o_orderstatus AS status, NULL AS \"user\", NULL AS name, 'orders' AS source_sheet FROM orders",
    "events": "SELECT event_id, value, NULL, user_id, NULL, 'events' FROM events",
    "suppliers": "SELECT s_suppkey, s_acctbal, NULL, NULL, s_name, 'suppliers' FROM supplier",
}

_SHEET_NAMES = """WITH names AS (SELECT p_type || CASE p_size % 3 WHEN 0 THEN ' ' WHEN 1 THEN '!' ELSE '__' END || p_brand
  || CASE WHEN p_size < 10 THEN ' ' ELSE '' END AS raw, min(p_partkey) AS position FROM part GROUP BY 1),
tokens AS (SELECT raw, position, coalesce(nullif(lower(trim(regexp_replace(raw, '[^0-9a-zA-Z]+', '_', 'g'), '_')), ''), 'worksheet') AS token FROM names)"""

_COUNTRIES = """lookup AS (SELECT n_name AS "Country", CASE WHEN n_nationkey % 6 <> 0 THEN r_name END AS "Region"
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_BAYS = f"""bays AS (SELECT "Product", max(size) % 12 + 1 AS "Bays" FROM (
  SELECT {RAW_PRODUCT_SQL} AS "Product", size FROM (SELECT p_partkey AS part_id, p_size AS size FROM part)) GROUP BY 1)"""
_RATE = """CAST(CASE "Currency" WHEN 'AUD' THEN 0.63 WHEN 'EUR' THEN 1.05 WHEN 'JPY' THEN 0.0067
  WHEN 'TWD' THEN 0.031 WHEN 'USD' THEN 1.00 ELSE 0.54354 END AS DECIMAL(12,6))"""

_CLEAN = f"""WITH {RAW_SQL}, {_COUNTRIES}, {_BAYS},
typed AS (
  SELECT * REPLACE ({_nulls('"Customer"')} AS "Customer", {_nulls('"ItemCode"')} AS "ItemCode",
    {_nulls('"Product"')} AS "Product", {_nulls('"ShipTo"')} AS "ShipTo", {_nulls('"Currency"')} AS "Currency",
    TRY_CAST("Quantity" AS DOUBLE) AS "Quantity", TRY_CAST("Price" AS DOUBLE) AS "Price", TRY_CAST("Total" AS DOUBLE) AS "Total")
  FROM raw
),
kept AS (
  SELECT * REPLACE (coalesce("Quantity", 0) AS "Quantity", regexp_replace("Product", '^\\([^)]*\\)\\s*', '') AS "Product") FROM typed
  WHERE ("Quantity" >= 0 OR "Quantity" IS NULL) AND "Total" >= 0 AND "Customer" IS NOT NULL AND "Product" IS NOT NULL
),
moded AS (
  SELECT * REPLACE (coalesce("Currency", (SELECT "Currency" FROM kept WHERE "Currency" IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS "Currency", {date_sql('"InvDate"')} AS "InvDate",
    {date_sql('"ShipDate"')} AS "ShipDate", coalesce("ShipTo", 'UNKNOWN') AS "ShipTo",
    coalesce("ItemCode", "Product", 'UNSPECIFIED') AS "ItemCode"),
    {category_sql('"Product"')} AS "Type" FROM kept
),
placed AS (
  SELECT m.* REPLACE (coalesce(m."Region", l."Region") AS "Region") FROM moded m LEFT JOIN lookup l ON m."Country" = l."Country"
),
group_mode AS (
  SELECT "Country", "Region" AS mode FROM (
    SELECT "Country", "Region", row_number() OVER (PARTITION BY "Country" ORDER BY count(*) DESC, "Region") AS place
    FROM placed WHERE "Region" IS NOT NULL GROUP BY 1, 2) WHERE place = 1
),
filled AS (SELECT p.* REPLACE (coalesce(p."Region", g.mode) AS "Region") FROM placed p LEFT JOIN group_mode g USING ("Country"))
SELECT {_K}, "PI", "Customer", "ItemCode", f."Product", source_sheet, "Quantity",
  CAST(CAST("Price" AS DECIMAL(20,6)) * {_RATE} AS DOUBLE) AS usd_adjusted_price,
  CAST(CAST("Total" AS DECIMAL(20,6)) * {_RATE} AS DOUBLE) AS usd_adjusted_total,
  "InvDate", "Country", "Type", {subcategory_sql('f."Product"', '"Type"')} AS sub_cat,
  CAST(year("InvDate") AS INTEGER) AS "Year",
  coalesce("Region", (SELECT "Region" FROM filled WHERE "Region" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS "Region",
  "ShipTo", "ShipDate", "Currency", {capacity_sql('f."Product"', '"Type"')} AS "Capacity",
  CASE WHEN "Type" = 'DRIVE' THEN "Quantity" ELSE 0 END * coalesce({capacity_sql('f."Product"', '"Type"')}, 0) AS total_cap,
  "Bays", "Bays" * "Quantity" AS total_bays
FROM filled f LEFT JOIN bays b ON f."Product" = b."Product" """


def _staging(suite: str | None) -> str:
    chosen = "" if suite is None else f"AND channel IN ({', '.join(repr(x) for x in SUITES[suite])})"
    number = "CASE WHEN regexp_full_match(trim({0}), '-?\\d+(\\.\\d+)?') THEN CAST(greatest(CAST({0} AS DECIMAL(28,8)), 0) AS DOUBLE) END"
    return f"""WITH {RAW_SQL}, staged AS (SELECT
      CASE WHEN regexp_full_match(trim("InvDate"), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST("InvDate" AS DATE) END AS sale_date,
      nullif({_strip('"ItemCode"')}, '') AS item_code, nullif({_strip('"Product"')}, '') AS product_name,
      coalesce(nullif({_strip('"ItemCode"')}, ''), nullif({_strip('"Product"')}, '')) AS sku, source_sheet AS channel,
      {number.format('"Quantity"')} AS quantity, {number.format('"Total"')} AS revenue FROM raw)
      SELECT * FROM staged WHERE sale_date IS NOT NULL AND sku IS NOT NULL {chosen}"""


ORACLES = {
    "scan_sheet_folder": """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance,
        NULL AS total, c_mktsegment AS source_sheet FROM customer
        UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, NULL, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR), 'vendors+' || s_nationkey FROM supplier""",
    "scan_union_by_name": " UNION ALL ".join(_SHEETS.values()),
    "scan_select_sheets": """SELECT s_suppkey AS id, s_acctbal AS total, s_name AS name, 'suppliers' AS source_sheet, NULL AS status FROM supplier
        UNION ALL SELECT o_orderkey, o_totalprice, NULL, 'orders', o_orderstatus FROM orders""",
    "sanitize_names": f"{_SHEET_NAMES} SELECT raw, token FROM tokens",
    "dedupe_names": f"""{_SHEET_NAMES} SELECT raw, token || CASE WHEN nth > 1 THEN '_' || nth ELSE '' END AS name FROM (
        SELECT *, row_number() OVER (PARTITION BY token ORDER BY position, raw) AS nth FROM tokens)""",
    "normalise_nulls": f"""WITH {RAW_SQL} SELECT {_K}, {_nulls('"Customer"')} AS "Customer", {_nulls('"ItemCode"')} AS "ItemCode",
        {_nulls('"Product"')} AS "Product", {_nulls('"Country"', False)} AS "Country", {_nulls('"ShipTo"')} AS "ShipTo" FROM raw""",
    "coerce_numeric": f"""WITH {RAW_SQL} SELECT {_K}, TRY_CAST("Total" AS DOUBLE) AS "Total", TRY_CAST("Price" AS DOUBLE) AS "Price",
        TRY_CAST("Quantity" AS DOUBLE) AS "Quantity" FROM raw""",
    "clean_sales": _CLEAN,
    "strip_prefix": f"{_PRODUCTS} SELECT part_id, regexp_replace(product, '^\\([^)]*\\)\\s*', '') AS product FROM products",
    "classify_category": f"{_PRODUCTS} SELECT part_id, product, {category_sql('product')} AS category FROM products",
    "classify_subcategory": f"""{_PRODUCTS}, typed AS (SELECT *, {category_sql('product')} AS category FROM products)
        SELECT part_id, product, category, {subcategory_sql('product', 'category')} AS subcategory FROM typed""",
    "service_code": f"{_PRODUCTS} SELECT part_id, product, {service_code_sql('product')} AS code FROM products",
    "drive_capacity": f"""WITH {SALES_SQL}, named AS (SELECT {_K}, quantity, {RAW_PRODUCT_SQL} AS "Product" FROM sales),
        typed AS (SELECT *, {category_sql('"Product"')} AS kind FROM named),
        sized AS (SELECT *, {capacity_sql('"Product"', 'kind')} AS "Capacity" FROM typed)
        SELECT {_K}, "Product", "Capacity", CASE WHEN "Capacity" IS NOT NULL THEN 'GB' END AS "Unit",
        CAST(CASE WHEN kind = 'DRIVE' THEN quantity ELSE 0 END * coalesce("Capacity", 0) AS DOUBLE) AS total_cap FROM sized""",
    "service_family": f"""{_PRODUCTS} SELECT part_id, product, CASE
        WHEN contains(lower(product), 'active insight') THEN 'Active Insight'
        WHEN contains(lower(product), 'activeprotect') OR contains(lower(product), 'active protect') THEN 'ActiveProtect'
        WHEN contains(lower(product), 'c2 password') THEN 'C2 Password'
        WHEN contains(lower(product), 'c2 backup') THEN 'C2 Backup'
        WHEN contains(lower(product), 'c2 storage') OR (contains(lower(product), 'object') AND contains(lower(product), 'c2')) THEN 'C2 Storage/Object'
        WHEN contains(lower(product), 'c2 transfer') THEN 'C2 Transfer'
        WHEN contains(lower(product), 'c2') THEN 'C2 (Other)' ELSE 'Other' END AS family FROM products""",
    "parse_code": f"WITH {SALES_SQL} SELECT {_K}, "
    + ", ".join(f"coalesce(nullif(split_part(upper(code), '-', {n}), ''), 'UNKNOWN') AS part_{n}" for n in (2, 3, 4, 5))
    + " FROM sales",
    "fx_convert": f"""WITH {SALES_SQL} SELECT {_K}, currency, CAST(rate AS DOUBLE) AS exchange_rate_to_usd,
        CAST(price * rate AS DOUBLE) AS usd_adjusted_price, CAST(total * rate AS DOUBLE) AS usd_adjusted_total FROM sales""",
    "country_region": f"""WITH {SALES_SQL}, {_COUNTRIES} SELECT {_K}, s.country AS "Country", l."Region" AS "Region"
        FROM sales s LEFT JOIN lookup l ON s.country = l."Country" """,
    "device_bays": f"""WITH {SALES_SQL}, {_BAYS}, named AS (SELECT {_K}, CAST(quantity AS DOUBLE) AS quantity, {RAW_PRODUCT_SQL} AS "Product" FROM sales)
        SELECT {_K}, "Product", quantity, "Bays", "Bays" * quantity AS total_bays FROM named LEFT JOIN bays USING ("Product")""",
    "fill_mode": f"""WITH {SALES_SQL} SELECT {_K}, coalesce(currency, (SELECT currency FROM sales WHERE currency IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS currency FROM sales""",
    "fill_group_mode": f"""WITH {SALES_SQL}, gaps AS (SELECT {_K}, country,
        CASE WHEN order_id % 5 <> 0 AND order_id % 7 <> 0 THEN region END AS region FROM sales),
        modes AS (SELECT country, region AS mode FROM (SELECT country, region,
        row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, region) AS place
        FROM gaps WHERE region IS NOT NULL GROUP BY 1, 2) WHERE place = 1)
        SELECT {_K}, country, coalesce(region, mode) AS region FROM gaps LEFT JOIN modes USING (country)""",
    "fill_mean": f"""WITH {SALES_SQL}, gaps AS (SELECT {_K}, CASE WHEN order_id % 10 <> 0 THEN price END AS price FROM sales)
        SELECT {_K}, coalesce(CAST(price AS DOUBLE), (SELECT round(avg(price), 6) FROM gaps)) AS price FROM gaps""",
    "staging_sales": _staging(None),
    "staging_suite_a": _staging("suite_a"),
    "staging_suite_b": _staging("suite_b"),
    "suite_split": f"""WITH {SALES_SQL} SELECT {_K}, source_sheet, CASE WHEN source_sheet IN ('1995', '1996') THEN 'suite_a' ELSE 'suite_b' END AS suite
        FROM sales WHERE source_sheet IN ('1995', '1996', '1997', '1998')""",
    "standardise_text": "SELECT p_partkey, upper(p_name || ' ' || p_brand) AS sku FROM part",
    "calendar_features": """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, last_day(CAST(o_orderdate AS DATE)) AS month_end,
        CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
        CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
        CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
        CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year FROM orders""",
    "clip_nonneg": """SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN greatest(c_acctbal - 5000, 0) END AS balance FROM customer""",
}
