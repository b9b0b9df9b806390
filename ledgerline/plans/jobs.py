"""End-to-end jobs: from sheets to cleaned lines, marts, forecasts and loads.

Each is a composition of operators with one write at the end of every branch.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text
from ..operators import clean, forecast, periodic, staging, subscription
from ..session import settle
from ..sources import readers, writers

# --- cleaning ------------------------------------------------------------------------


def clean_sheets(
    spark: SparkSession,
    folder: str,
    output: str,
    sheets: Sequence[str] | None = None,
    suites: Mapping[str, Sequence[str]] | None = None,
    country_regions: DataFrame | None = None,
    device_bays: DataFrame | None = None,
) -> DataFrame:
    """Read the sheets, clean them and write the export, split by suite if asked.

    The suites are cut from the written export, so the cleaning runs once.
    """
    raw = readers.read_sheets(spark, folder, sheets)
    cleaned = clean.clean_sales(raw, country_regions=country_regions, device_bays=device_bays)
    writers.write_projected(cleaned, output)
    written = spark.read.parquet(output)
    if suites:
        writers.write_suites(staging.split_suites(written, dict(suites)), f"{output}_suites")
    return written


# --- quarterly training frames -----------------------------------------------------------


def quarterly_training_frames(
    spark: SparkSession,
    path: str,
    value: str = "usd_adjusted_total",
    segments: Sequence[str] = (),
    date: str | None = None,
    focus: tuple[str, Sequence[str]] | None = None,
) -> tuple[DataFrame, DataFrame, Column]:
    """History, latest quarter and its start, over all lines or the focus products."""
    lines = readers.read_clean_sales(spark, path)
    if focus:
        column, products = focus
        _, quarterly = periodic.quarterly_views(lines, value, column, products, segments, date)
    else:
        quarterly = periodic.quarterly_totals(lines, value, segments, date)
    train, test, latest = periodic.split_latest(settle(quarterly))
    periodic.require_split(train, test)
    return train, test, latest


# --- subscription marts ----------------------------------------------------------------------


def subscription_lines(cleaned: DataFrame, prefix: str = fixed.SUBSCRIPTION_PREFIX) -> DataFrame:
    """Cleaned lines under the column names the marts expect."""
    names = {
        "inv_date": "InvDate", "order_id": "PI", "customer": "Customer", "product": "Product", "code": "sub_cat",
        "region": "Region", "country": "Country", "quantity": "Quantity", "usd_total": "usd_adjusted_total",
        "item_code": "ItemCode",
    }
    lines = cleaned.select(*[F.col(source).alias(name) for name, source in names.items()])
    money = {c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(21,7)") for c in ("quantity", "usd_total")}
    return subscription.subscription_lines(lines.withColumns(money), prefix)


def subscription_marts(subs: DataFrame) -> dict[str, tuple[DataFrame, Sequence[str]]]:
    """The scorecard and its seven companions, each with its sort order.

    Churn and retention share the paid grain, which is settled.
    """
    paid = settle(subscription.paid_grain(subs))
    card = subscription.adoption_scorecard(subs).withColumn("created_at", F.current_timestamp())
    return {
        "adoption_scorecard": (card, subscription.SCORECARD_KEYS),
        "subscription_monthly": (subscription.subscription_monthly(subs), ("snapshot_month", "service_family")),
        "subscription_totals": (subscription.subscription_totals(subs), ("snapshot_month",)),
        "logo_churn": (subscription.logo_churn(paid), ("snapshot_month",)),
        "revenue_churn": (subscription.revenue_churn(paid), ("snapshot_month",)),
        "retention": (subscription.retention(paid), ("service_family", "months_since_start")),
        "family_summary": (subscription.revenue_by(subs, {"family": "service_family"}), ("service_family",)),
        "country_summary": (subscription.revenue_by(subs, {"country": "country"}), ("country",)),
    }


def publish_marts(spark: SparkSession, marts: Mapping[str, tuple[DataFrame, Sequence[str]]], folder: str) -> list[str]:
    """Refresh every mart and export it as sorted CSV; empty marts keep their old rows."""
    done = []
    for name, (df, order) in marts.items():
        if writers.refresh(df, f"{folder}/{name}"):
            stored = spark.read.parquet(f"{folder}/{name}")
            done += writers.export_marts({name: (stored, order)}, f"{folder}/csv")
    return done


# --- forecasts ----------------------------------------------------------------------------------


def train_baseline(
    spark: SparkSession, output: str, run_id: str, parquet: str | None, csv_folder: str,
    cutoff: str = fixed.HOLDOUT_START, horizon: int = fixed.HORIZON_MONTHS, window: int = fixed.ROLLING_WINDOW,
) -> DataFrame:
    """History to baseline forecast, written with its metadata."""
    monthly = periodic.monthly_history(readers.load_history(spark, parquet, csv_folder))
    made = settle(forecast.baseline_forecast(monthly, ("sku", "channel"), cutoff, horizon, window))
    if made.isEmpty():
        raise ValueError(f"no series has months before {cutoff}")
    writers.write_forecast(
        made, output, run_id, "baseline", "rolling_mean_baseline",
        rolling_window_months=window, holdout_start=cutoff, forecast_horizon_months=horizon,
    )
    return made


@dataclass
class CohortForecast:
    """What a cohort forecast produced."""

    forecast: DataFrame
    combined: DataFrame
    metrics: DataFrame


def train_cohort(
    cleaned: DataFrame, output: str, run_id: str, cohort: str, sheets: Sequence[str] | None = None,
    prefix: str = fixed.FOCUS_PREFIX, holdout: str = fixed.HOLDOUT_START, horizon: int = fixed.HORIZON_MONTHS,
) -> CohortForecast:
    """Seasonal forecast of the monthly series of a cohort, with actuals and holdout error."""
    needed = ("InvDate", "Quantity", "usd_adjusted_total", "sub_cat", "source_sheet")
    lines = periodic.require_columns(cleaned, needed).filter(text.has_prefix(F.col("sub_cat"), prefix))
    if sheets:
        lines = lines.filter(F.col("source_sheet").isin(*sheets))
    dated = lines.select(
        F.col("InvDate").try_cast("date").alias("sale_date"),
        F.col("Quantity").cast("decimal(18,2)").alias("quantity"),
        F.col("usd_adjusted_total").cast("decimal(21,7)").alias("revenue"),
    ).filter(F.col("sale_date").isNotNull())
    sku = F.lit(f"{cohort.upper()}_ALL").alias("sku")
    series = settle(periodic.monthly_series(dated).select(sku, F.lit(cohort).alias("channel"), "*"))
    train, test = periodic.holdout_split(series, "sale_month", holdout)
    if train.isEmpty():
        raise ValueError(f"no months before {holdout}")
    keys = ("sku", "channel")
    made = settle(forecast.seasonal_forecast(train, keys, horizon))
    actuals = series.select(
        *keys, "sale_month", F.col("quantity").cast("double").alias("actual_quantity"),
        F.col("revenue").cast("double").alias("actual_revenue"),
    )
    combined = forecast.combine(actuals, made, keys).withColumn("forecast_date", F.col("sale_month"))
    pairs = test.select(*keys, "sale_month", F.col("revenue").cast("double").alias("actual")).join(
        made.select(*keys, F.col("forecast_date").alias("sale_month"), "forecast_revenue"), [*keys, "sale_month"]
    )
    error = forecast.ape(F.col("actual"), F.col("forecast_revenue"))
    metrics = forecast.mape(pairs, ("channel",), error)
    writers.write_forecast(made, output, run_id, cohort, "seasonal_difference", holdout_start=holdout)
    writers.writer(combined, "csv").save(f"{output}/{cohort}_combined_{run_id}")
    metrics.write.mode("overwrite").json(f"{output}/{cohort}_metrics_{run_id}")
    return CohortForecast(made, combined, metrics)


def read_runs(spark: SparkSession, folder: str, stem: str) -> DataFrame | None:
    """All written runs of a kind with their run id, or None when there are none."""
    try:
        files = spark.read.option("header", True).csv(f"{folder}/{stem}_*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    run = F.regexp_extract(F.col("_metadata.file_path"), rf"/{stem}_([^/]+)/", 1)
    return files.select("*", run.alias("run_id"))


def load_forecast(
    spark: SparkSession, folder: str, name: str, mart: str, cohort: str, model_name: str, model_version: str,
    actuals: DataFrame | None = None,
) -> bool:
    """Load the latest run into the forecast mart; loading it again changes nothing.

    ``actuals`` has ``sale_month``, ``sku`` and the actual and product columns.
    """
    runs = read_runs(spark, folder, f"{name}_forecast")
    if runs is None:
        return False
    combined = read_runs(spark, folder, f"{name}_combined")
    rows = settle(readers.latest_run(runs) if combined is None else readers.prefer_combined(combined, runs))
    newest = rows.agg(F.max("run_id").alias("run_id")).collect()[0].run_id
    if newest is None:
        return False
    ready = writers.prepare_forecast(rows, cohort, newest, model_name, model_version)
    if actuals is not None:
        own = [c for c in ready.columns if c in rows.columns or c not in actuals.columns or c in ("sku", "sale_month")]
        ready = writers.conform(
            forecast.add_actuals(ready.select(*own), actuals, {"sale_month": "sale_month", "sku": "sku"}),
            fixed.FORECAST_MART,
        )
    writers.load_partitions(ready, mart, ("cohort", "model_name", "model_version"))
    return True
