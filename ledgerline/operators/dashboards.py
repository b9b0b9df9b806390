"""The eight dashboard queries over the adoption scorecard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..functions.periods import quarter_start


def exact(c: str) -> Column:
    """Sum whose result does not depend on the order of rows."""
    return F.sum(F.col(c).cast("decimal(28,7)")).cast("double").alias(c)


def count_sum(c: str) -> Column:
    return F.sum(c).alias(c)


def weighted_seats() -> Column:
    seats = F.sum((F.col("active_subscriptions") * F.col("avg_seats")).cast("decimal(28,7)"))
    return F.round(ratio(seats, F.sum("active_subscriptions")), 6).alias("weighted_avg_seats")


def between(card: DataFrame, first: str, last: str) -> DataFrame:
    return card.filter(F.col("snapshot_month").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def snapshot_tiles(card: DataFrame, family: str, first: str, last: str) -> DataFrame:
    """Key figures of the latest month of one family. One scan, no join.

    The month totals are calendar-sized; the latest of them is the answer.
    """
    chosen = between(card.filter(F.col("service_family") == family), first, last)
    months = chosen.groupBy(F.col("snapshot_month").alias("latest_snapshot")).agg(
        count_sum("active_subscriptions"),
        count_sum("new_subscriptions"),
        exact("mrr_usd"),
        exact("total_quantity"),
        weighted_seats(),
    )
    return months.orderBy(F.col("latest_snapshot").desc()).limit(1)


def region_heatmap(card: DataFrame, first: str, last: str) -> DataFrame:
    keys = ("snapshot_month", "region", "service_family")
    return between(card, first, last).groupBy(*keys).agg(exact("mrr_usd"), count_sum("new_subscriptions"))


def tier_contribution(card: DataFrame, first: str, last: str) -> DataFrame:
    return (
        between(card, first, last)
        .groupBy("snapshot_month", "customer_tier")
        .agg(
            count_sum("active_subscriptions"),
            count_sum("new_subscriptions"),
            exact("mrr_usd"),
            weighted_seats(),
        )
    )


def plan_mix(card: DataFrame, month: str) -> DataFrame:
    chosen = card.filter(F.col("snapshot_month") == F.lit(month).cast("date"))
    return chosen.groupBy("plan_variant").agg(
        exact("mrr_usd"), exact("total_quantity"), count_sum("new_subscriptions")
    )


def trend(card: DataFrame, region: str, family: str) -> DataFrame:
    chosen = card.filter((F.col("region") == region) & (F.col("service_family") == family))
    return chosen.groupBy("snapshot_month").agg(
        count_sum("active_subscriptions"), count_sum("new_subscriptions"), exact("mrr_usd")
    )


def quarter_growth(card: DataFrame, first: str, last: str) -> DataFrame:
    """Growth against the quarter before. The date filter follows the window."""
    quarters = card.groupBy(
        quarter_start(F.col("snapshot_month")).alias("snapshot_quarter"), "service_family"
    ).agg(exact("mrr_usd"), count_sum("active_subscriptions"))
    order = Window.partitionBy("service_family").orderBy("snapshot_quarter")
    prior = F.lag("mrr_usd").over(order)
    ranked = quarters.withColumn("prior_mrr_usd", prior)
    change = ratio(F.col("mrr_usd") - F.col("prior_mrr_usd"), F.col("prior_mrr_usd")) * 100
    return ranked.withColumn("mrr_percentage_change", F.round(change, 2)).filter(
        F.col("snapshot_quarter").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def drilldown(card: DataFrame, first: str, last: str) -> DataFrame:
    keys = ("snapshot_month", "region", "customer_tier", "service_family", "plan_variant")
    return (
        between(card, first, last)
        .groupBy(*keys)
        .agg(
            count_sum("active_subscriptions"),
            count_sum("new_subscriptions"),
            exact("mrr_usd"),
            exact("total_quantity"),
            weighted_seats(),
        )
    )


def freshness(card: DataFrame) -> DataFrame:
    return card.agg(
        F.max("snapshot_month").alias("latest_snapshot"),
        F.count("*").alias("row_count"),
        count_sum("active_subscriptions"),
        count_sum("new_subscriptions"),
        exact("mrr_usd"),
    )
