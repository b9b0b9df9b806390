"""Registered queries: subscription marts and dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text
from ..operators import dashboards as dash
from ..operators import series
from ..operators import subscription as sub
from ..session import settle
from .views import FOCUS, PREFIX, SALES_SQL, parts, sales, table

FIRST, LAST, MONTH = "1997-01-01", "1998-12-31", "1998-10-31"
REGION, FAMILY = "ASIA", "PROMO"
FAMILIES = [label for label, _ in fixed.FAMILY_RULES] + [fixed.DEFAULT_FAMILY]


def subs(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Subscription lines, classified on the product dimension."""
    products = sub.subscription_products(parts(spark, sf), PREFIX)
    derived = ("family", "service_family", "plan_variant")
    return sub.subscription_lines(
        sales(spark, sf, "inv_date", "usd_total", *derived, *extra, products=products)
    )


def card(spark: SparkSession, sf: str) -> DataFrame:
    """Some lines have no order number."""
    lines = subs(spark, sf, "customer", "order_id", "region", "quantity")
    order = F.when(F.col("order_id") % 31 != 0, F.col("order_id"))
    # counted from the footers of the files
    return sub.adoption_scorecard(lines, table(spark, sf, "lineitem").count(), order)


_STORED: dict[tuple, DataFrame] = {}


def stored_card(spark: SparkSession, sf: str) -> DataFrame:
    """The scorecard as a mart: written when first asked for, read by all dashboards until its tables change."""
    files = spark.read.format("binaryFile").load([f"{sf}/{name}.parquet" for name in ("lineitem", "orders", "customer", "nation", "region", "part")])
    state = files.agg(F.max("modificationTime"), F.sum("length"), F.count("*")).first()
    key = (spark.sparkContext.applicationId, sf, *state)
    if key not in _STORED:
        _STORED[key] = settle(card(spark, sf))
    return _STORED[key]


def paid(spark: SparkSession, sf: str) -> DataFrame:
    return sub.paid_grain(subs(spark, sf, "customer"))


def credited(spark: SparkSession, sf: str) -> DataFrame:
    """The paid grain where some orders are credits, below zero."""
    lines = subs(spark, sf, "customer", "order_id")
    credit = F.when(F.col("order_id") % 3 == 0, -F.col("usd_total")).otherwise(F.col("usd_total"))
    return sub.paid_grain(lines.withColumn("usd_total", credit))


def latest_12_months(spark: SparkSession, sf: str) -> DataFrame:
    totals = sub.subscription_totals(subs(spark, sf, "customer"))
    return totals.orderBy(F.col("snapshot_month").desc()).limit(12)


def family_pivot(spark: SparkSession, sf: str) -> DataFrame:
    monthly = sub.subscription_monthly(subs(spark, sf, "customer"))
    return sub.pivot_months(monthly, "snapshot_month", "service_family", FAMILIES, "mrr_usd")


def retention_matrix(spark: SparkSession, sf: str) -> DataFrame:
    ages = sub.retention(paid(spark, sf))
    return sub.pivot_months(ages, "months_since_start", "service_family", FAMILIES, "active_logos")


def cumulative_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Running revenue per family over its months: windows over the monthly grain."""
    monthly = (
        subs(spark, sf).groupBy("family", "month").agg(F.sum("usd_total").alias("revenue"))
    )
    total = series.running_total(monthly, ("family",), "month", "revenue", "cumulative_revenue")
    return total.withColumns({c: sub.double(c) for c in ("revenue", "cumulative_revenue")})


def growth_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Quarter growth by region and family, from the quarterly aggregate."""
    lines = subs(spark, sf, "region").withColumn("quarter", F.trunc("inv_date", "quarter"))
    quarters = lines.groupBy("region", "family", "quarter").agg(F.sum("usd_total").alias("revenue"))
    prior = F.lag("revenue").over(Window.partitionBy("region", "family").orderBy("quarter"))
    now, then = sub.double("revenue"), sub.double(prior)
    return quarters.select(
        "region", "family", "quarter", now.alias("revenue"), then.alias("prior_revenue"),
        F.round(F.try_divide(now - then, then) * 100, 4).alias("growth_pct"),
    )


def subscription_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = sales(spark, sf, "order_id", "part_id", "line_no", "supplier_id", "product", "code")
    return rows.filter(text.is_subscription(F.col("product"), F.col("code"), "SUB-SMALL"))


def focus_prefix_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = sales(spark, sf, "order_id", "part_id", "line_no", "supplier_id", "code")
    return rows.filter(text.has_prefix(F.col("code"), FOCUS.lower()))


QUERIES = {
    "adoption_scorecard": card,
    "customer_tiers": lambda s, d: sub.customer_tiers(subs(s, d, "customer")).withColumn(
        "revenue", sub.double("revenue")
    ),
    "customer_tiers_ordinal": lambda s, d: sub.customer_tiers_ordinal(
        subs(s, d, "customer")
    ).withColumn("revenue", sub.double("revenue")),
    "subscription_monthly": lambda s, d: sub.subscription_monthly(subs(s, d, "customer")),
    "subscription_totals": lambda s, d: sub.subscription_totals(subs(s, d, "customer")),
    "latest_12_months": latest_12_months,
    "paid_grain": lambda s, d: paid(s, d).withColumn("revenue", sub.double("revenue")),
    "logo_churn": lambda s, d: sub.logo_churn(credited(s, d)),
    "revenue_churn": lambda s, d: sub.revenue_churn(credited(s, d)),
    "retention": lambda s, d: sub.retention(paid(s, d)),
    "retention_matrix": retention_matrix,
    "family_pivot": family_pivot,
    "family_summary": lambda s, d: sub.revenue_by(subs(s, d), {"family": "service_family"}),
    "family_monthly": lambda s, d: sub.revenue_by(
        subs(s, d), {"month": "snapshot_month", "family": "service_family"}
    ),
    "country_summary": lambda s, d: sub.revenue_by(subs(s, d, "country"), {"country": "country"}),
    "country_top20": lambda s, d: sub.top_by(
        sub.revenue_by(subs(s, d, "country"), {"country": "country"}), "revenue_usd", "country", 20
    ),
    "region_summary": lambda s, d: sub.revenue_by(subs(s, d, "region"), {"region": "region"}),
    "customer_spend": lambda s, d: sub.revenue_by(
        subs(s, d, "customer"), {"customer": "customer"}, "total_spend"
    ),
    "service_summary": lambda s, d: sub.service_summary(
        subs(s, d, "customer", "item_code", "quantity")
    ),
    "top5_customers": lambda s, d: sub.top_customers(subs(s, d, "customer"), "family", 5),
    "cumulative_revenue": cumulative_revenue,
    "growth_matrix": growth_matrix,
    "subscription_filter": subscription_filter,
    "focus_prefix_filter": focus_prefix_filter,
    "q1_snapshot_tiles": lambda s, d: dash.snapshot_tiles(stored_card(s, d), FAMILY, FIRST, LAST),
    "q2_region_heatmap": lambda s, d: dash.region_heatmap(stored_card(s, d), FIRST, LAST),
    "q3_tier_contribution": lambda s, d: dash.tier_contribution(stored_card(s, d), FIRST, LAST),
    "q4_plan_mix": lambda s, d: dash.plan_mix(stored_card(s, d), MONTH),
    "q5_trend": lambda s, d: dash.trend(stored_card(s, d), REGION, FAMILY),
    "q6_qoq_growth": lambda s, d: dash.quarter_growth(stored_card(s, d), FIRST, LAST),
    "q7_drilldown": lambda s, d: dash.drilldown(stored_card(s, d), FIRST, LAST),
    "q8_freshness": lambda s, d: dash.freshness(stored_card(s, d)),
}

_WORDS = "(?i)" + "|".join(fixed.SUBSCRIPTION_WORDS)


def _part(n: int) -> str:
    return f"coalesce(nullif(split_part(upper(code), '-', {n}), ''), 'UNKNOWN')"


SUBS_SQL = f"""{SALES_SQL},
subs AS (
  SELECT *, last_day(inv_date) AS month, {_part(2)} AS service_family, {_part(3)} AS capacity_band,
         {_part(4)} AS plan_variant,
         CASE WHEN lower(product) LIKE '%active insight%' THEN 'Active Insight'
              WHEN lower(product) LIKE '%activeprotect%' OR lower(product) LIKE '%active protect%' THEN 'ActiveProtect'
              WHEN lower(product) LIKE '%c2 password%' THEN 'C2 Password'
              WHEN lower(product) LIKE '%c2 backup%' THEN 'C2 Backup'
              WHEN lower(product) LIKE '%c2 storage%'
                OR (lower(product) LIKE '%object%' AND lower(product) LIKE '%c2%') THEN 'C2 Storage/Object'
              WHEN lower(product) LIKE '%c2 transfer%' THEN 'C2 Transfer'
              WHEN lower(product) LIKE '%c2%' THEN 'C2 (Other)' ELSE 'Other' END AS family
  FROM usd WHERE starts_with(upper(code), '{PREFIX}') OR regexp_matches(product, '{_WORDS}')
),
tiers AS (
  SELECT customer, sum(usd_total) AS revenue,
         dense_rank() OVER (ORDER BY sum(usd_total) DESC) AS place,
         row_number() OVER (ORDER BY sum(usd_total) DESC, customer) AS ordinal
  FROM subs GROUP BY customer
),
card AS (
  SELECT month AS snapshot_month, service_family, plan_variant, region,
         CASE WHEN place <= 5 THEN 'Tier 1 - Top 5' WHEN place <= 20 THEN 'Tier 2 - Top 20'
              ELSE 'Tier 3 - Long Tail' END AS customer_tier, 'ALL' AS sku,
         count(DISTINCT customer) AS active_subscriptions, count(DISTINCT CASE WHEN order_id % 31 <> 0 THEN order_id END)
           + max(CASE WHEN order_id % 31 = 0 THEN 1 ELSE 0 END) AS new_subscriptions,
         CAST(sum(usd_total) AS DOUBLE) AS mrr_usd, CAST(sum(quantity) AS DOUBLE) AS total_quantity,
         CAST(sum(quantity) AS DOUBLE) / count(DISTINCT customer) AS avg_seats
  FROM subs JOIN tiers USING (customer) GROUP BY ALL
),
paid AS (SELECT month, customer, family, sum(usd_total) AS revenue FROM subs GROUP BY ALL),
credited AS (SELECT month, customer, family, sum(CASE WHEN order_id % 3 = 0 THEN -usd_total ELSE usd_total END) AS revenue
  FROM subs GROUP BY ALL),
months AS (SELECT month, lag(month) OVER (ORDER BY month) AS previous FROM (SELECT DISTINCT month FROM credited)),
pairs AS (SELECT DISTINCT customer, family FROM credited),
steps AS (
  SELECT m.month, coalesce(now.revenue, 0::DECIMAL(38,7)) AS cur, coalesce(was.revenue, 0::DECIMAL(38,7)) AS prev
  FROM months m CROSS JOIN pairs p
  LEFT JOIN credited now ON now.month = m.month AND now.customer = p.customer AND now.family = p.family
  LEFT JOIN credited was ON was.month = m.previous AND was.customer = p.customer AND was.family = p.family
  WHERE m.previous IS NOT NULL
),
monthly AS (
  SELECT month, family, sum(usd_total) AS mrr, count(DISTINCT customer) AS active FROM subs GROUP BY ALL
),
ages AS (
  SELECT p.family AS service_family,
         CAST((year(p.month) * 12 + month(p.month)) - (year(s.start) * 12 + month(s.start)) AS INTEGER) AS months_since_start,
         count(DISTINCT p.customer) AS active_logos
  FROM paid p JOIN (SELECT customer, family, min(month) AS start FROM paid WHERE revenue > 0 GROUP BY ALL) s
    ON s.customer = p.customer AND s.family = p.family
  WHERE p.revenue > 0 GROUP BY ALL
)"""


def _q(body: str) -> str:
    return f"WITH {SUBS_SQL}\n{body}"


_SEATS = """round(CAST(sum(CAST(active_subscriptions * avg_seats AS DECIMAL(28,7))) AS DOUBLE)
  / nullif(sum(active_subscriptions), 0), 6) AS weighted_avg_seats"""
_ACTIVE = "CAST(sum(active_subscriptions) AS BIGINT) AS active_subscriptions"
_NEW = "CAST(sum(new_subscriptions) AS BIGINT) AS new_subscriptions"
_MRR = "CAST(sum(CAST(mrr_usd AS DECIMAL(28,7))) AS DOUBLE) AS mrr_usd"
_QTY = "CAST(sum(CAST(total_quantity AS DECIMAL(28,7))) AS DOUBLE) AS total_quantity"
_RANGE = f"snapshot_month BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"


def _pivot(measure: str, source: str, key: str, kind: str) -> str:
    cells = ", ".join(
        f"""CAST(coalesce(sum({measure}) FILTER (service_family = '{f}'), 0) AS {kind}) AS "{f}\"""" for f in FAMILIES
    )
    return f"SELECT {key}, {cells} FROM {source} GROUP BY ALL"


def _revenue(keys: str, value: str = "revenue_usd", tail: str = "") -> str:
    return _q(f"SELECT {keys}, CAST(sum(usd_total) AS DOUBLE) AS {value} FROM subs GROUP BY ALL {tail}")


ORACLES = {
    "adoption_scorecard": _q("SELECT * FROM card"),
    "customer_tiers": _q(
        """SELECT customer, CAST(revenue AS DOUBLE) AS revenue,
        CASE WHEN place <= 5 THEN 'Tier 1 - Top 5' WHEN place <= 20 THEN 'Tier 2 - Top 20'
             ELSE 'Tier 3 - Long Tail' END AS customer_tier FROM tiers"""
    ),
    "customer_tiers_ordinal": _q(
        """SELECT customer, CAST(revenue AS DOUBLE) AS revenue,
        CASE WHEN ordinal <= 5 THEN 'Tier 1 - Top 5' WHEN ordinal <= 20 THEN 'Tier 2 - Top 20'
             ELSE 'Tier 3 - Long Tail' END AS customer_tier FROM tiers"""
    ),
    "subscription_monthly": _q(
        """SELECT month AS snapshot_month, family AS service_family, CAST(mrr AS DOUBLE) AS mrr_usd,
        CAST(CAST(mrr AS DECIMAL(30,7)) * CAST(12 AS DECIMAL(3,0)) AS DOUBLE) AS arr_usd, active AS active_subscriptions FROM monthly"""
    ),
    "subscription_totals": _q(
        """SELECT month AS snapshot_month, CAST(sum(mrr) AS DOUBLE) AS mrr_total,
        CAST(CAST(sum(mrr) AS DECIMAL(30,7)) * CAST(12 AS DECIMAL(3,0)) AS DOUBLE) AS arr_total, CAST(sum(active) AS BIGINT) AS active_subs_total
        FROM monthly GROUP BY month"""
    ),
    "latest_12_months": _q(
        """SELECT month AS snapshot_month, CAST(sum(mrr) AS DOUBLE) AS mrr_total,
        CAST(CAST(sum(mrr) AS DECIMAL(30,7)) * CAST(12 AS DECIMAL(3,0)) AS DOUBLE) AS arr_total, CAST(sum(active) AS BIGINT) AS active_subs_total
        FROM monthly GROUP BY month ORDER BY month DESC LIMIT 12"""
    ),
    "paid_grain": _q("SELECT month, customer, family, CAST(revenue AS DOUBLE) AS revenue FROM paid"),
    "logo_churn": _q(
        """SELECT month AS snapshot_month, count(*) FILTER (cur > 0 AND prev <= 0) AS new_logos,
        count(*) FILTER (cur <= 0 AND prev > 0) AS churned_logos,
        count(*) FILTER (cur > 0) - count(*) FILTER (prev > 0) AS net_logos FROM steps GROUP BY month"""
    ),
    "revenue_churn": _q(
        """SELECT month AS snapshot_month, CAST(sum(least(cur, prev)) AS DOUBLE) AS kept_revenue,
        CAST(sum(greatest(cur - prev, 0::DECIMAL(38,7))) AS DOUBLE) AS expansion_revenue,
        CAST(sum(greatest(prev - cur, 0::DECIMAL(38,7))) AS DOUBLE) AS contraction_revenue,
        CAST(sum(greatest(prev - cur, 0::DECIMAL(38,7))) AS DOUBLE) AS churned_revenue,
        CAST(sum(cur) - sum(prev) AS DOUBLE) AS net_change FROM steps GROUP BY month"""
    ),
    "retention": _q("SELECT * FROM ages"),
    "retention_matrix": _q(_pivot("active_logos", "ages", "months_since_start", "BIGINT")),
    "family_pivot": _q(
        _pivot("mrr_usd", "(SELECT month AS snapshot_month, family AS service_family, CAST(mrr AS DOUBLE) AS mrr_usd FROM monthly)", "snapshot_month", "DOUBLE")
    ),
    "family_summary": _revenue("family AS service_family"),
    "family_monthly": _revenue("month AS snapshot_month, family AS service_family"),
    "country_summary": _revenue("country"),
    "country_top20": _revenue("country", tail="ORDER BY revenue_usd DESC, country LIMIT 20"),
    "region_summary": _revenue("region"),
    "customer_spend": _revenue("customer", "total_spend"),
    "service_summary": _q(
        """SELECT service_family, plan_variant, CAST(sum(usd_total) AS DOUBLE) AS total_revenue,
        CAST(sum(quantity) AS DOUBLE) AS total_quantity, count(DISTINCT customer) AS customer_count,
        count(DISTINCT item_code) AS sku_count FROM subs GROUP BY ALL"""
    ),
    "top5_customers": _q(
        """SELECT family, customer, CAST(revenue AS DOUBLE) AS revenue, CAST(rank AS INTEGER) AS rank FROM (
        SELECT family, customer, sum(usd_total) AS revenue,
        row_number() OVER (PARTITION BY family ORDER BY sum(usd_total) DESC, customer) AS rank
        FROM subs GROUP BY family, customer) WHERE rank <= 5"""
    ),
    "cumulative_revenue": _q(
        """SELECT family, month, CAST(revenue AS DOUBLE) AS revenue,
        CAST(sum(revenue) OVER (PARTITION BY family ORDER BY month) AS DOUBLE) AS cumulative_revenue
        FROM (SELECT family, month, sum(usd_total) AS revenue FROM subs GROUP BY ALL)"""
    ),
    "growth_matrix": _q(
        """SELECT region, family, quarter, now AS revenue, prior AS prior_revenue,
        round((now - prior) / nullif(prior, 0) * 100, 4) AS growth_pct FROM (
        SELECT *, lag(now) OVER (PARTITION BY region, family ORDER BY quarter) AS prior FROM (
        SELECT region, family, CAST(date_trunc('quarter', inv_date) AS DATE) AS quarter,
        CAST(sum(usd_total) AS DOUBLE) AS now FROM subs GROUP BY ALL))"""
    ),
    "subscription_filter": f"""WITH {SALES_SQL} SELECT order_id, part_id, line_no, supplier_id, product, code
        FROM sales WHERE starts_with(upper(code), 'SUB-SMALL') OR regexp_matches(product, '{_WORDS}')""",
    "focus_prefix_filter": f"""WITH {SALES_SQL} SELECT order_id, part_id, line_no, supplier_id, code
        FROM sales WHERE starts_with(upper(code), '{FOCUS}')""",
    "q1_snapshot_tiles": _q(
        f"""SELECT max(snapshot_month) AS latest_snapshot, {_ACTIVE}, {_NEW}, {_MRR}, {_QTY}, {_SEATS} FROM card
        WHERE service_family = '{FAMILY}' AND snapshot_month = (
          SELECT max(snapshot_month) FROM card WHERE service_family = '{FAMILY}' AND {_RANGE})"""
    ),
    "q2_region_heatmap": _q(
        f"SELECT snapshot_month, region, service_family, {_MRR}, {_NEW} FROM card WHERE {_RANGE} GROUP BY ALL"
    ),
    "q3_tier_contribution": _q(
        f"SELECT snapshot_month, customer_tier, {_ACTIVE}, {_NEW}, {_MRR}, {_SEATS} FROM card WHERE {_RANGE} GROUP BY ALL"
    ),
    "q4_plan_mix": _q(
        f"SELECT plan_variant, {_MRR}, {_QTY}, {_NEW} FROM card WHERE snapshot_month = DATE '{MONTH}' GROUP BY ALL"
    ),
    "q5_trend": _q(
        f"""SELECT snapshot_month, {_ACTIVE}, {_NEW}, {_MRR} FROM card
        WHERE region = '{REGION}' AND service_family = '{FAMILY}' GROUP BY ALL"""
    ),
    "q6_qoq_growth": _q(
        f"""SELECT snapshot_quarter, service_family, mrr_usd, prior_mrr_usd, active_subscriptions,
        round((mrr_usd - prior_mrr_usd) / nullif(prior_mrr_usd, 0) * 100, 2) AS mrr_percentage_change FROM (
        SELECT *, lag(mrr_usd) OVER (PARTITION BY service_family ORDER BY snapshot_quarter) AS prior_mrr_usd FROM (
        SELECT CAST(date_trunc('quarter', snapshot_month) AS DATE) AS snapshot_quarter, service_family, {_MRR}, {_ACTIVE}
        FROM card GROUP BY ALL)) WHERE snapshot_quarter BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"""
    ),
    "q7_drilldown": _q(
        f"""SELECT snapshot_month, region, customer_tier, service_family, plan_variant, {_ACTIVE}, {_NEW}, {_MRR},
        {_QTY}, {_SEATS} FROM card WHERE {_RANGE} GROUP BY ALL"""
    ),
    "q8_freshness": _q(
        f"SELECT max(snapshot_month) AS latest_snapshot, count(*) AS row_count, {_ACTIVE}, {_NEW}, {_MRR} FROM card"
    ),
}
