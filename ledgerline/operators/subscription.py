"""Subscription marts: tiers, scorecard, recurring revenue, churn, retention.

Column contract of the input lines: ``inv_date, order_id, customer, product,
code, region, country, quantity, usd_total``. Money stays decimal inside, so sums
do not depend on row order, and becomes double in the last projection of a mart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text
from ..functions.numbers import ratio
from ..functions.periods import month_end, month_number
from ..session import settle

MONEY = "decimal(30,7)"


def double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def subscription_products(df: DataFrame, prefix: str = fixed.SUBSCRIPTION_PREFIX) -> DataFrame:
    """Rows of the subscription cohort with family and code parts.

    Needs ``product`` and ``code`` only: applied to the product dimension, it
    classifies each product once and the join with the lines does the filtering.
    """
    kept = df.filter(text.is_subscription(F.col("product"), F.col("code"), prefix))
    return kept.withColumns(
        {
            "family": text.service_family(F.col("product")),
            "service_family": text.code_part(F.col("code"), 2),
            "capacity_band": text.code_part(F.col("code"), 3),
            "plan_variant": text.code_part(F.col("code"), 4),
        }
    )


def subscription_lines(lines: DataFrame, prefix: str = fixed.SUBSCRIPTION_PREFIX) -> DataFrame:
    """Dated lines of the subscription cohort by month, classified unless they already are."""
    kept = lines.filter(F.col("inv_date").isNotNull())
    if "family" not in lines.columns:
        kept = subscription_products(kept, prefix)
    filled = {
        c: F.coalesce(F.col(c), F.lit("")) for c in ("customer", "region", "country") if c in lines.columns
    }
    return kept.withColumns({**filled, "month": month_end(F.col("inv_date"))})


# --- customer tiers -------------------------------------------------------------


def customer_revenue(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer").agg(F.sum("usd_total").alias("revenue"))


def tier_label(rank_below: Column, rank_below_20: Column) -> Column:
    return (
        F.when(rank_below, fixed.TIER_1).when(rank_below_20, fixed.TIER_2).otherwise(fixed.TIER_3)
    )


def _cut(ranked: DataFrame, column: str, rank: int) -> Column:
    """The ``rank``-th largest value of a column, null when there are fewer.

    Only the top values travel: each task keeps ``rank`` rows and so does the
    merge. No window over all customers is needed.
    """
    top = ranked.orderBy(F.col(column).desc()).limit(rank)
    return top.agg(F.when(F.count("*") >= rank, F.min(column)).alias(column)).scalar()


def customer_tiers(lines: DataFrame) -> DataFrame:
    """Tier by dense rank of revenue: customers with equal revenue share a tier."""
    revenue = customer_revenue(lines)
    amounts = revenue.select("revenue").distinct()
    first, second = (_cut(amounts, "revenue", r) for r in (fixed.TIER_1_RANKS, fixed.TIER_2_RANKS))
    return _label_by_cuts(revenue, F.col("revenue"), first, second)


def customer_tiers_ordinal(lines: DataFrame) -> DataFrame:
    """Tier by position: exactly 5 and 15 customers, ties broken by name."""
    place = F.struct(-F.col("revenue"), F.col("customer"))
    revenue = customer_revenue(lines)

    def last_of(rank: int) -> Column:
        top = revenue.orderBy(F.col("revenue").desc(), "customer").limit(rank)
        return top.agg(F.when(F.count("*") >= rank, F.max(place)).alias("place")).scalar()

    first, second = last_of(fixed.TIER_1_RANKS), last_of(fixed.TIER_2_RANKS)
    label = tier_label(first.isNull() | (place <= first), second.isNull() | (place <= second))
    return revenue.withColumn("customer_tier", label)


def _label_by_cuts(revenue: DataFrame, value: Column, first: Column, second: Column) -> DataFrame:
    label = tier_label(first.isNull() | (value >= first), second.isNull() | (value >= second))
    return revenue.withColumn("customer_tier", label)


def with_tier(lines: DataFrame, rows: int = 0) -> DataFrame:
    """Lines with their customer's tier. ``rows``: how many lines, if known.

    Everyone outside the top ranks is in the long tail, so the lookup holds the
    few leading customers only. It is settled: Spark knows its size and
    broadcasts it, unless equal revenues make it large. Either way the lines,
    skewed towards just these customers, are not grouped by customer.
    """
    leaders = customer_tiers(lines).filter(F.col("customer_tier") != fixed.TIER_3)
    lookup = settle(leaders.select("customer", "customer_tier"), rows)
    joined = lines.join(lookup, "customer", "left")
    return joined.withColumn("customer_tier", F.coalesce("customer_tier", F.lit(fixed.TIER_3)))


# --- scorecard and recurring revenue ----------------------------------------------

SCORECARD_KEYS = ("snapshot_month", "service_family", "plan_variant", "region", "customer_tier")


def order_grain(lines: DataFrame, rows: int = 0) -> DataFrame:
    """Revenue and quantity by month, family, plan, region, customer and order, written once.

    The one reduction of the lines that tiers, scorecard and dashboards start from.
    """
    keys = ("month", "service_family", "plan_variant", "region", "customer", "order_id")
    return settle(lines.groupBy(*keys).agg(F.sum("usd_total").alias("usd_total"), F.sum("quantity").alias("quantity")), rows)


def adoption_scorecard(lines: DataFrame, rows: int = 0, order: Column | None = None) -> DataFrame:
    """Customers, orders, revenue and seats by month, family, plan, region and tier.

    Lines are reduced to the order grain in one scan. Distinct customers and orders are two
    plain aggregates of the grain, put under each other and added up, so no row is expanded.
    Orders may be as many as lines, so each step that shuffles them is written with partitions
    for as many rows: ``rows`` lines, where the caller knows their number, then those of the grain.
    ``order``: the order counted, from ``order_id``; put in behind the grain, so that lines which
    were joined by their order number are grouped where they are.
    """
    grain = order_grain(lines, rows)
    held = grain.count()  # from the footers of its files
    if order is not None:
        grain = grain.withColumn("order_id", order)
    tiered = with_tier(grain, held).withColumnRenamed("month", "snapshot_month")
    by_customer = tiered.groupBy(*SCORECARD_KEYS, "customer").agg(F.sum("usd_total").alias("usd"), F.sum("quantity").alias("quantity"))
    by_order = tiered.select(*SCORECARD_KEYS, "order_id").distinct()
    none = F.lit(0).cast("long")
    customers = by_customer.groupBy(*SCORECARD_KEYS).agg(
        F.count("customer").alias("customers"), none.alias("orders"), F.sum("usd").alias("usd"), F.sum("quantity").alias("quantity")
    )
    # lines without an order number are one order
    orders = by_order.groupBy(*SCORECARD_KEYS).agg(none.alias("customers"), F.count("*").alias("orders"))
    grouped = settle(customers.unionByName(orders, allowMissingColumns=True), held).groupBy(*SCORECARD_KEYS).agg(
        F.sum("customers").alias("active_subscriptions"),
        F.sum("orders").alias("new_subscriptions"),
        double(F.sum("usd")).alias("mrr_usd"),
        double(F.sum("quantity")).alias("total_quantity"),
    )
    return grouped.select(
        *SCORECARD_KEYS,
        F.lit("ALL").alias("sku"),
        "active_subscriptions",
        "new_subscriptions",
        "mrr_usd",
        "total_quantity",
        ratio(F.col("total_quantity"), F.col("active_subscriptions")).alias("avg_seats"),
    )


def yearly(mrr: Column) -> Column:
    return double(mrr.cast(MONEY) * F.lit(12).cast("decimal(2,0)"))


def _monthly(lines: DataFrame) -> DataFrame:
    return lines.groupBy("month", "family").agg(
        F.sum("usd_total").cast(MONEY).alias("mrr"), F.countDistinct("customer").alias("active")
    )


def subscription_monthly(lines: DataFrame) -> DataFrame:
    """Monthly and yearly recurring revenue and customers per family."""
    return _monthly(lines).select(
        F.col("month").alias("snapshot_month"),
        F.col("family").alias("service_family"),
        double("mrr").alias("mrr_usd"),
        yearly(F.col("mrr")).alias("arr_usd"),
        F.col("active").alias("active_subscriptions"),
    )


def subscription_totals(lines: DataFrame) -> DataFrame:
    """Month totals; customers are the sum over families, as in the marts above."""
    totals = _monthly(lines).groupBy("month").agg(
        F.sum("mrr").alias("mrr"), F.sum("active").alias("active_subs_total")
    )
    return totals.select(
        F.col("month").alias("snapshot_month"),
        double("mrr").alias("mrr_total"),
        yearly(F.col("mrr")).alias("arr_total"),
        "active_subs_total",
    )


def paid_grain(lines: DataFrame) -> DataFrame:
    """One row per month, customer and family. Feeds churn and retention."""
    return lines.groupBy("month", "customer", "family").agg(F.sum("usd_total").alias("revenue"))


# --- churn and retention -----------------------------------------------------------


def month_transitions(paid: DataFrame) -> DataFrame:
    """Per observed month: what changed against the observed month before it.

    A customer and family pair has at most one row per month, so the window below
    is bounded by the calendar however large a customer is. Its rows are folded
    at once into one row per (month, previous month, next month); all that
    follows works on that calendar-sized table. A pair that is absent in a month
    had no revenue in it; credits below zero count like any other revenue.
    """
    pair = Window.partitionBy("customer", "family").orderBy("month")
    zero = F.lit(0).cast("int")
    rev = F.col("revenue")
    near = paid.withColumns(
        {
            "before": F.lag("month").over(pair),
            "after": F.lead("month").over(pair),
            "rev_before": F.lag("revenue").over(pair),
            "rev_after": F.lead("revenue").over(pair),
        }
    )
    folded = near.groupBy("month", "before", "after").agg(
        F.count_if(rev > 0).alias("active"),
        F.sum(rev).alias("revenue"),
        F.count_if((rev > 0) & (F.col("rev_before") <= 0)).alias("new"),
        F.sum(F.least(rev, F.col("rev_before"))).alias("kept"),
        F.sum(F.greatest(rev - F.col("rev_before"), zero)).alias("gain"),
        F.count_if((rev > 0) & (F.col("rev_after") <= 0)).alias("gone"),
        F.sum(F.greatest(rev - F.col("rev_after"), zero)).alias("loss"),
        F.sum(F.greatest(rev, zero)).alias("above"),
        F.sum(F.least(rev, zero)).alias("below"),
    )
    # Calendar-sized from here on: the windows without a partition key are over it.
    number = month_number(F.col("month"))
    earlier = Window.orderBy("n").rangeBetween(Window.unboundedPreceding, -1)
    # Descending, because a frame that grows is read once and one that shrinks is not.
    later = Window.orderBy(F.col("n").desc()).rangeBetween(Window.unboundedPreceding, -1)
    placed = folded.withColumn("n", number).withColumns(
        {"previous": F.max("month").over(earlier), "following": F.min("month").over(later)}
    )
    joined = F.coalesce(F.col("before") == F.col("previous"), F.lit(False))
    stays = F.coalesce(F.col("after") == F.col("following"), F.lit(False))
    none = F.lit(0).cast("decimal(38,7)")
    absent = F.lit(0).cast("bigint")

    def side(month: Column, is_previous: bool, **parts: Column) -> Column:
        return F.struct(
            month.alias("month"),
            F.lit(is_previous).alias("has_previous"),
            *[
                parts.get(n, absent).cast("bigint").alias(n) for n in ("new_logos", "churned_logos")
            ],
            *[
                parts.get(n, none).cast("decimal(38,7)").alias(n)
                for n in ("kept", "expansion", "lost", "now", "was")
            ],
        )

    sides = F.array(
        side(
            F.col("month"),
            False,
            new_logos=F.when(joined, F.col("new")).otherwise(F.col("active")),
            kept=F.when(joined, F.col("kept")).otherwise(F.col("below")),
            expansion=F.when(joined, F.col("gain")).otherwise(F.col("above")),
            lost=F.when(joined, none).otherwise(-F.col("below")),
            now=F.col("revenue"),
        ),
        side(
            F.col("following"),
            True,
            churned_logos=F.when(stays, F.col("gone")).otherwise(F.col("active")),
            kept=F.when(stays, none).otherwise(F.col("below")),
            expansion=F.when(stays, none).otherwise(-F.col("below")),
            lost=F.when(stays, F.col("loss")).otherwise(F.col("above")),
            was=F.col("revenue"),
        ),
    )
    merged = placed.select(F.explode(sides).alias("s")).select("s.*").filter("month is not null")
    measures = ("new_logos", "churned_logos", "kept", "expansion", "lost", "now", "was")
    return (
        merged.groupBy("month")
        .agg(F.max("has_previous").alias("has_previous"), *[F.sum(m).alias(m) for m in measures])
        .filter("has_previous")
        .drop("has_previous")
    )


def logo_churn(paid: DataFrame) -> DataFrame:
    return month_transitions(paid).select(
        F.col("month").alias("snapshot_month"),
        "new_logos",
        "churned_logos",
        (F.col("new_logos") - F.col("churned_logos")).alias("net_logos"),
    )


def revenue_churn(paid: DataFrame) -> DataFrame:
    """Contraction and churn are the same amount by definition: every loss counts."""
    return month_transitions(paid).select(
        F.col("month").alias("snapshot_month"),
        double("kept").alias("kept_revenue"),
        double("expansion").alias("expansion_revenue"),
        double("lost").alias("contraction_revenue"),
        double("lost").alias("churned_revenue"),
        double(F.col("now").cast(MONEY) - F.col("was").cast(MONEY)).alias("net_change"),
    )


def retention(paid: DataFrame) -> DataFrame:
    """Customers per family and months since their first paid month.

    The paid grain has one row per month, customer and family, so counting rows
    counts distinct customers.
    """
    pair = Window.partitionBy("customer", "family")
    active = paid.filter(F.col("revenue") > 0)
    aged = active.withColumn("start", F.min("month").over(pair))
    age = month_number(F.col("month")) - month_number(F.col("start"))
    return (
        aged.select(F.col("family").alias("service_family"), age.alias("months_since_start"))
        .groupBy("service_family", "months_since_start")
        .agg(F.count("*").alias("active_logos"))
    )


# --- summaries -----------------------------------------------------------------------


def revenue_by(lines: DataFrame, keys: dict[str, str], value: str = "revenue_usd") -> DataFrame:
    """Revenue by the columns ``keys`` maps from, named as it maps to."""
    names = [F.col(source).alias(target) for source, target in keys.items()]
    return lines.groupBy(*names).agg(double(F.sum("usd_total")).alias(value))


def top_by(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """The ``k`` largest rows; each task keeps only ``k``."""
    return df.orderBy(F.col(measure).desc(), F.col(key)).limit(k)


def top_customers(lines: DataFrame, cohort: str, k: int = 5) -> DataFrame:
    """The ``k`` leading customers of every cohort.

    Spark cuts each cohort to ``k`` rows before the shuffle (window group limit),
    so a cohort with a third of all customers does not land in one task.
    """
    place = Window.partitionBy(cohort).orderBy(F.col("revenue").desc(), F.col("customer"))
    revenue = lines.groupBy(cohort, "customer").agg(F.sum("usd_total").alias("revenue"))
    ranked = revenue.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.withColumn("revenue", double("revenue"))


def service_summary(lines: DataFrame) -> DataFrame:
    return lines.groupBy("service_family", "plan_variant").agg(
        double(F.sum("usd_total")).alias("total_revenue"),
        double(F.sum("quantity")).alias("total_quantity"),
        F.countDistinct("customer").alias("customer_count"),
        F.countDistinct("item_code").alias("sku_count"),
    )


def pivot_months(df: DataFrame, row: str, column: str, values: list[str], measure: str) -> DataFrame:
    """Rows by ``row``, one column per value given, missing cells 0."""
    return df.groupBy(row).pivot(column, values).agg(F.sum(measure)).na.fill(0)
