"""Registered queries: forecasts, their evaluation and the forecast mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import forecast, periodic, regression, subscription
from ..operators.subscription import double
from ..session import settle
from ..sources import writers
from .periods import CUTOFF, _sales, history, money, monthly_actuals
from .series import rounded
from .views import sales

HORIZON = 3
CUTOFFS = ("1999-10-01", "2000-04-01", "2000-10-01")
LIMIT = 40.0
ACT = 10.0


def monthly(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """Monthly quantity and revenue by sale columns."""
    rows = sales(spark, sf, "inv_date", "quantity", "usd_total", *keys).withColumnsRenamed(
        {"inv_date": "sale_date", "usd_total": "revenue"}
    )
    return periodic.monthly_history(rows, keys)


def months(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """The same, written once: for keys of few values and queries that use it twice."""
    return settle(monthly(spark, sf, *keys))


def baseline(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    return forecast.baseline_forecast(monthly(spark, sf, *keys), keys, CUTOFF, HORIZON)


def baseline_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """One forecast per sku and channel."""
    history_months = periodic.monthly_history(history(spark, sf))
    return forecast.baseline_forecast(history_months, ("sku", "channel"), CUTOFF, HORIZON)


def pairs(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """Forecast and actual revenue of the holdout months."""
    known = months(spark, sf, *keys)
    predicted = forecast.baseline_forecast(known, keys, CUTOFF, HORIZON).withColumnRenamed("forecast_date", "sale_month")
    actual = money(known, "revenue", "quantity")
    return predicted.join(actual, [*keys, "sale_month"]).select(
        *keys, "sale_month", F.col("revenue").alias("actual"), F.col("forecast_revenue").alias("predicted"),
        F.col("quantity").alias("actual_quantity"), F.col("forecast_quantity").alias("predicted_quantity"),
    )


def with_actuals(spark: SparkSession, sf: str, attributes: dict[str, str]) -> DataFrame:
    """Baseline per product next to the actuals it was made from: one pass over the lines."""
    lines = sales(spark, sf, "inv_date", "product", "type", "quantity", "usd_total")
    known = settle(periodic.monthly_actuals(lines.withColumn("sku", F.col("product")), attributes))
    renamed = known.withColumnsRenamed({"actual_quantity": "quantity", "actual_revenue": "revenue"})
    predicted = forecast.baseline_forecast(renamed, ("sku",), CUTOFF, HORIZON)
    actuals = money(known, "actual_quantity", "actual_revenue")
    return forecast.add_actuals(predicted, actuals, {"forecast_date": "sale_month", "sku": "sku"})


def forecast_vs_actual(spark: SparkSession, sf: str) -> DataFrame:
    return with_actuals(spark, sf, {"product_type": "type"})


def actual_forecast_combined(spark: SparkSession, sf: str) -> DataFrame:
    """Actuals up to the cutoff month, forecasts after it, on one axis."""
    known = months(spark, sf, "type")
    actual = money(known, "quantity", "revenue").withColumnsRenamed(
        {"quantity": "actual_quantity", "revenue": "actual_revenue"}
    )
    return forecast.combine(actual, forecast.baseline_forecast(known, ("type",), CUTOFF, 12), ("type",))


def forecast_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast volume times mean price, with the actual revenue of the month."""
    rows = sales(spark, sf, "inv_date", "product", "quantity", "usd_total", "usd_price")
    known = settle(
        rows.groupBy("product", F.last_day("inv_date").alias("sale_month")).agg(
            F.sum("quantity").alias("quantity"), F.sum("usd_total").alias("revenue"),
            F.sum("usd_price").alias("prices"), F.count("usd_price").alias("priced"),
        )
    )
    volume = forecast.baseline_forecast(known, ("product",), CUTOFF, HORIZON).drop("forecast_revenue")
    price = known.groupBy("product").agg(
        (F.sum("prices").cast("double") / F.sum("priced")).alias("avg_price")
    )
    actual = known.select(
        "product", F.col("sale_month").alias("forecast_date"), double("revenue").alias("actual_revenue")
    )
    joined = volume.join(price, "product", "left").join(actual, ["product", "forecast_date"], "left")
    return joined.select(
        "product",
        "forecast_date",
        F.round("forecast_quantity", 2).alias("forecast_volume"),
        F.round(F.coalesce("actual_revenue", F.lit(0.0)), 2).alias("actual_revenue"),
        F.round("avg_price", 2).alias("avg_price"),
        F.round(F.col("forecast_quantity") * F.col("avg_price"), 2).alias("forecast_revenue"),
    )


def product_mape(spark: SparkSession, sf: str) -> DataFrame:
    error = forecast.ape_floor_one(F.col("actual_quantity"), F.col("predicted_quantity"))
    measured = rounded(forecast.mape(pairs(spark, sf, "product"), ("product",), error), "mape")
    return measured.withColumn("cohort", forecast.confidence(F.col("mape")))


def confidence_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Number and mean error of the products in each confidence cohort."""
    exact = F.sum(F.col("mape").cast("decimal(28,6)")).cast("double")
    return product_mape(spark, sf).groupBy("cohort").agg(
        F.count("*").alias("number_of_products"), F.round(exact / F.count("*"), 6).alias("average_mape")
    )


def quarters(spark: SparkSession, sf: str) -> DataFrame:
    lines = sales(spark, sf, "inv_date", "region", "usd_total")
    return periodic.quarterly_totals(lines, "usd_total", ("region",), "inv_date", fill_gaps=False).select(
        "region", "sale_quarter", "quarter_total"
    )


def rolling_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the last-quarter baseline over rolling four quarters."""
    named = forecast.naive_baselines(quarters(spark, sf), ("region",), "sale_quarter", "quarter_total")
    known = named.filter(F.col("naive").isNotNull()).withColumnsRenamed(
        {"quarter_total": "actual", "naive": "predicted"}
    )
    return rounded(forecast.rolling_rmse(known, ("region",), "sale_quarter"), "rolling_rmse", digits=4)


def backtest(spark: SparkSession, sf: str) -> DataFrame:
    out = forecast.backtest(months(spark, sf, "type"), ("type",), CUTOFFS, HORIZON, 3)
    return money(out, "revenue")


def forecast_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast for every customer, with the tier and what the holdout months say about it.

    The lines are aggregated once, to customer and month; tiers, forecasts and errors
    come from that table.
    """
    known = months(spark, sf, "customer")
    predicted = forecast.baseline_forecast(known, ("customer",), CUTOFF, HORIZON)
    actual = known.select("customer", F.col("sale_month").alias("forecast_date"), double("revenue").alias("actual"))
    error = forecast.ape(F.col("actual"), F.col("forecast_revenue"))
    measured = forecast.mape(predicted.join(actual, ["customer", "forecast_date"]), ("customer",), error)
    measured = rounded(measured, "mape")
    tiers = subscription.customer_tiers(known.withColumnRenamed("revenue", "usd_total")).drop("revenue")
    out = predicted.join(tiers, "customer").join(measured, "customer", "left")
    return out.withColumn("confidence", forecast.confidence(F.col("mape")))


def activation_variance(spark: SparkSession, sf: str) -> DataFrame:
    """Actual against forecast per month, region and segment.

    Cover, market index and score have no source and stay empty. The action and the
    note follow from the variance alone.
    """
    gap = F.round(F.try_divide(F.col("actual") - F.col("predicted"), F.col("predicted")) * 100, 6)
    none = F.lit(None).cast("double")
    story = pairs(spark, sf, "region", "segment").select(
        F.col("sale_month").alias("snapshot_month"), "region", "segment", F.col("actual").alias("actual_revenue"),
        F.col("predicted").alias("forecast_revenue"), gap.alias("variance_pct"), none.alias("inventory_weeks_cover"),
        none.alias("market_index_score"), none.alias("activation_score"),
    )
    below, above = F.col("variance_pct") < -ACT, F.col("variance_pct") > ACT
    action = F.when(below, "activate").when(above, "secure supply").otherwise("hold")
    return story.withColumns(
        {"recommended_action": action, "confidence_note": forecast.confidence(F.abs("variance_pct"))}
    )


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Error measures of the run by data slice, stamped with the end of its holdout."""
    known = pairs(spark, sf, "region", "type")
    stamp = known.agg(F.max("sale_month").cast("timestamp_ntz").alias("t")).scalar()
    measured = forecast.metrics(known, ("region",), band=0.5).withColumn("data_slice", F.concat(F.lit("region="), "region"))
    return rounded(measured, "mape", "rmse", "coverage", digits=4).select(
        F.lit("20001001T000000Z").alias("forecast_run_id"), stamp.alias("measured_until"), "data_slice", "points", "mape", "rmse", "coverage"
    )


def seasonal_forecast(spark: SparkSession, sf: str) -> DataFrame:
    made = forecast.seasonal_forecast(train_series(spark, sf, "region", "type"), ("region", "type"), HORIZON)
    return rounded(made, *[c for c in made.columns if c.startswith("forecast_") and c != "forecast_date"], digits=4)


def trend_regression(spark: SparkSession, sf: str) -> DataFrame:
    lines = forecast.trend(monthly(spark, sf, "region", "type"), ("region", "type"), "sale_month", "revenue")
    return rounded(rounded(lines, "slope", digits=4), "next_value", "next_lower", "next_upper", digits=2)


REGRESSORS = ("lag_1", "lag_2", "lag_4", "quarter_no")


def quarter_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Quarterly totals on lags and time, fitted before the first cutoff, with what the model says of every quarter."""
    lagged = forecast.quarter_features(quarters(spark, sf), ("region",), "sale_quarter", "quarter_total", CUTOFF)
    number = F.year("sale_quarter") * 4 + F.quarter("sale_quarter")
    rows = settle(lagged.withColumn("quarter_no", number).select("region", "sale_quarter", "quarter_total", *REGRESSORS))
    past = rows.filter(F.col("sale_quarter") < F.lit(CUTOFFS[0]).cast("date"))
    model = regression.fit(past, ("region",), REGRESSORS, "quarter_total")
    out = regression.predict(rows, model, ("region",), REGRESSORS)
    return rounded(out.select("region", "sale_quarter", "quarter_total", "fitted", "lower", "upper"), "fitted", "lower", "upper", digits=1)


def train_series(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """Contiguous months before the cutoff, per series."""
    past, _ = periodic.holdout_split(monthly(spark, sf, *keys), "sale_month", CUTOFF)
    return periodic.fill_month_gaps(past, ("quantity", "revenue"), keys)


def mart_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The latest baseline run in the shape of the forecast mart."""
    attributes = {"product_name": "product", "product_type": "type", "product_subcategory": "type"}
    joined = with_actuals(spark, sf, attributes)
    return writers.conform(
        joined.withColumn("sale_month", F.col("forecast_date")),
        fixed.FORECAST_MART,
        forecast_run_id="20001001T000000Z", cohort="all", model_name="baseline",
        model_version="rolling_mean_v1", channel="all",
    )


QUERIES = {
    "baseline_forecast": baseline_forecast,
    "forecast_vs_actual": forecast_vs_actual,
    "actual_forecast_combined": actual_forecast_combined,
    "forecast_revenue": forecast_revenue,
    "holdout_mape": lambda s, d: rounded(
        forecast.mape(pairs(s, d, "type"), ("type",), forecast.ape(F.col("actual"), F.col("predicted"))), "mape"
    ),
    "mape_floor1": lambda s, d: product_mape(s, d).drop("cohort"),
    "forecast_metrics": lambda s, d: rounded(
        forecast.metrics(pairs(s, d, "region", "type"), ("region",), band=0.5),
        "mape", "smape", "wape", "rmse", "coverage", digits=4,
    ),
    "rolling_rmse": rolling_rmse,
    "mape_gate": lambda s, d: forecast.over_limit(product_mape(s, d).drop("cohort"), LIMIT),
    "confidence_summary": confidence_summary,
    "confidence_members": lambda s, d: product_mape(s, d).select("cohort", "product"),
    "series_eligibility": lambda s, d: forecast.eligibility(monthly(s, d, "product"), ("product",), CUTOFF),
    "naive_baselines": lambda s, d: forecast.naive_baselines(
        quarters(s, d), ("region",), "sale_quarter", "quarter_total"
    ).withColumn("rolling_mean", F.round("rolling_mean", 2)),
    "quarter_features": lambda s, d: rounded(
        forecast.quarter_features(quarters(s, d), ("region",), "sale_quarter", "quarter_total", CUTOFF),
        "mean_4", "stddev_4", digits=4,
    ),
    "backtest": backtest,
    "trend_regression": trend_regression,
    "quarter_regression": quarter_regression,
    "seasonal_forecast": seasonal_forecast,
    "run_metrics": run_metrics,
    "forecast_by_customer": forecast_by_customer,
    "activation_variance": activation_variance,
    "forecast_mart": lambda s, d: mart_rows(s, d).drop("created_at"),
}


def _monthly(keys: str) -> str:
    return f"""monthly AS (SELECT {keys}, last_day(inv_date) AS sale_month, sum(quantity) AS quantity,
      sum(usd_total) AS revenue FROM usd GROUP BY ALL)"""


def _baseline(keys: str, horizon: int = HORIZON) -> str:
    ends = ", ".join(f"last_day(last_day(DATE '{CUTOFF}') + INTERVAL {i} MONTH)" for i in range(1, horizon + 1))
    return f"""baseline AS (SELECT {keys}, unnest([{ends}]) AS forecast_date, forecast_quantity, forecast_revenue FROM (
      SELECT {keys}, CAST(sum(quantity) AS DOUBLE) / count(*) AS forecast_quantity,
        CAST(sum(revenue) AS DOUBLE) / count(*) AS forecast_revenue FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY sale_month DESC) AS age FROM monthly
        WHERE sale_month < last_day(DATE '{CUTOFF}')) WHERE age <= 3 GROUP BY {keys}))"""


def _pairs(keys: str) -> str:
    return f"""{_monthly(keys)}, {_baseline(keys)}, pairs AS (SELECT {keys}, sale_month, CAST(revenue AS DOUBLE) AS actual,
      forecast_revenue AS predicted, CAST(quantity AS DOUBLE) AS actual_quantity, forecast_quantity AS predicted_quantity
      FROM (SELECT {keys}, forecast_date AS sale_month, forecast_quantity, forecast_revenue FROM baseline)
      JOIN monthly USING ({keys}, sale_month))"""


_MAPE = """mapes AS (SELECT product, round(avg(abs(actual_quantity - predicted_quantity) / greatest(actual_quantity, 1)) * 100, 6) AS mape
  FROM pairs GROUP BY product), rated AS (SELECT *, CASE WHEN mape < 20 THEN 'High Confidence' WHEN mape < 50 THEN 'Moderate Confidence'
  ELSE 'Low Confidence' END AS cohort FROM mapes)"""
_QUARTERS = """quarters AS (SELECT region, CAST(date_trunc('quarter', inv_date) AS DATE) AS sale_quarter,
  CAST(sum(usd_total) AS DOUBLE) AS quarter_total FROM usd GROUP BY ALL)"""
_BEFORE = "(PARTITION BY region ORDER BY sale_quarter ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)"
_BY_QUARTER = "OVER (PARTITION BY region ORDER BY sale_quarter)"


def _backtest() -> str:
    arms = []
    for c in CUTOFFS:
        arms.append(
            f"""SELECT type, DATE '{c}' AS cutoff, unnest([last_day(last_day(DATE '{c}') + INTERVAL 1 MONTH),
            last_day(last_day(DATE '{c}') + INTERVAL 2 MONTH), last_day(last_day(DATE '{c}') + INTERVAL 3 MONTH)]) AS sale_month, forecast_revenue
            FROM (SELECT type, CAST(sum(revenue) AS DOUBLE) / count(*) AS forecast_revenue FROM (
            SELECT *, row_number() OVER (PARTITION BY type ORDER BY sale_month DESC) AS age FROM monthly
            WHERE sale_month < last_day(DATE '{c}')) WHERE age <= 3 GROUP BY type)"""
        )
    return f", {_monthly('type')}, runs AS ({' UNION ALL '.join(arms)}) " + """
      SELECT type, cutoff, sale_month, forecast_revenue, CAST(revenue AS DOUBLE) AS revenue FROM runs LEFT JOIN monthly USING (type, sale_month)"""


def _regression() -> str:
    """Each regressor without what the ones before it explain, one after the other; the target on these independent parts."""
    names = ("lag_1", "lag_2", "lag_4", "quarter_no")
    steps = [f"""features AS (SELECT *, sale_quarter < DATE '{CUTOFFS[0]}' AND lag_4 IS NOT NULL AS past FROM (SELECT region, sale_quarter, quarter_total,
        {", ".join(f"CAST(lag(quarter_total, {k}) {_BY_QUARTER} AS DOUBLE) AS lag_{k}" for k in (1, 2, 4))},
        CAST(year(sale_quarter) * 4 + quarter(sale_quarter) AS DOUBLE) AS quarter_no FROM quarters) WHERE sale_quarter < DATE '{CUTOFF}')"""]
    last = "features"
    whole = "FILTER (past) OVER (PARTITION BY region)"
    for i, name in enumerate(names):
        explained = "".join(f" - z{k} * sum({name} * z{k}) {whole} / sum(z{k} * z{k}) {whole}" for k in range(i))
        steps.append(f"f{i} AS (SELECT *, {name} - avg({name}) {whole}{explained} AS z{i} FROM {last})")
        last = f"f{i}"
    y = "CAST(quarter_total AS DOUBLE)"
    told = " + ".join(f"z{k} * sum({y} * z{k}) {whole} / sum(z{k} * z{k}) {whole}" for k in range(len(names)))
    reach = " + ".join(f"z{k} * z{k} / sum(z{k} * z{k}) {whole}" for k in range(len(names)))
    return f""", {_QUARTERS}, {", ".join(steps)},
        told AS (SELECT *, avg({y}) {whole} + {told} AS fitted, 1.0 / count(*) {whole} + {reach} AS leverage FROM {last}),
        spread AS (SELECT *, {fixed.CONFIDENCE_Z} * sqrt(sum(({y} - fitted) ** 2) {whole} / (count(*) {whole} - {len(names) + 1})) * sqrt(1 + leverage) AS margin FROM told)
        SELECT region, sale_quarter, quarter_total, round(fitted, 1) AS fitted, round(fitted - margin, 1) AS lower, round(fitted + margin, 1) AS upper FROM spread"""


ORACLES = {
    "baseline_forecast": _sales(
        f""", base AS (SELECT *, item_code AS sku, region AS channel FROM usd),
        monthly AS (SELECT sku, channel, last_day(inv_date) AS sale_month, sum(quantity) AS quantity, sum(usd_total) AS revenue FROM base GROUP BY ALL),
        {_baseline('sku, channel')} SELECT * FROM baseline"""
    ),
    "forecast_vs_actual": _sales(
        f""", {_monthly('product')}, {_baseline('product')}, kinds AS (SELECT product, last_day(inv_date) AS sale_month, min(type) AS product_type FROM usd GROUP BY ALL)
        SELECT b.product AS sku, forecast_date, forecast_quantity, forecast_revenue, CAST(quantity AS DOUBLE) AS actual_quantity,
        CAST(revenue AS DOUBLE) AS actual_revenue, product_type FROM baseline b LEFT JOIN monthly m ON b.product = m.product AND forecast_date = m.sale_month
        LEFT JOIN kinds k ON k.product = m.product AND k.sale_month = m.sale_month"""
    ),
    "actual_forecast_combined": _sales(
        f""", {_monthly('type')}, {_baseline('type', 12)} SELECT coalesce(m.type, b.type) AS type, coalesce(sale_month, forecast_date) AS sale_month,
        CAST(quantity AS DOUBLE) AS actual_quantity, CAST(revenue AS DOUBLE) AS actual_revenue, forecast_quantity, forecast_revenue
        FROM monthly m FULL JOIN baseline b ON m.type = b.type AND sale_month = forecast_date"""
    ),
    "forecast_revenue": _sales(
        f""", {_monthly('product')}, {_baseline('product')}, prices AS (SELECT product, CAST(sum(usd_price) AS DOUBLE) / count(usd_price) AS avg_price FROM usd GROUP BY 1)
        SELECT b.product, forecast_date, round(forecast_quantity, 2) AS forecast_volume, round(coalesce(CAST(revenue AS DOUBLE), 0), 2) AS actual_revenue,
        round(avg_price, 2) AS avg_price, round(forecast_quantity * avg_price, 2) AS forecast_revenue
        FROM baseline b LEFT JOIN prices p ON p.product = b.product LEFT JOIN monthly m ON m.product = b.product AND sale_month = forecast_date"""
    ),
    "holdout_mape": _sales(
        f", {_pairs('type')} SELECT type, round(avg(abs(actual - predicted) / nullif(abs(actual), 0)) * 100, 6) AS mape FROM pairs GROUP BY type"
    ),
    "mape_floor1": _sales(f", {_pairs('product')}, {_MAPE} SELECT * FROM mapes"),
    "forecast_metrics": _sales(
        f""", {_pairs('region, type')} SELECT region, count(*) AS points, round(avg(abs(actual - predicted) / nullif(abs(actual), 0)) * 100, 4) AS mape,
        round(avg(2 * abs(actual - predicted) / nullif(abs(actual) + abs(predicted), 0)) * 100, 4) AS smape,
        round(sum(abs(actual - predicted)) / sum(abs(actual)) * 100, 4) AS wape, round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,
        round(avg(CASE WHEN actual BETWEEN predicted * 0.5 AND predicted * 1.5 THEN 1.0 ELSE 0.0 END), 4) AS coverage FROM pairs GROUP BY region"""
    ),
    "rolling_rmse": _sales(
        f""", {_QUARTERS}, errors AS (SELECT region, sale_quarter, (quarter_total - lag(quarter_total) {_BY_QUARTER}) ** 2 AS sq FROM quarters)
        SELECT region, sale_quarter, round(sqrt(avg(sq) OVER (PARTITION BY region ORDER BY sale_quarter ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)), 4) AS rolling_rmse
        FROM errors WHERE sq IS NOT NULL"""
    ),
    "mape_gate": _sales(f", {_pairs('product')}, {_MAPE} SELECT * FROM mapes WHERE mape > {LIMIT}"),
    "confidence_summary": _sales(
        f""", {_pairs('product')}, {_MAPE} SELECT cohort, count(*) AS number_of_products,
        round(CAST(sum(CAST(mape AS DECIMAL(28,6))) AS DOUBLE) / count(*), 6) AS average_mape FROM rated GROUP BY cohort"""
    ),
    "confidence_members": _sales(f", {_pairs('product')}, {_MAPE} SELECT cohort, product FROM rated"),
    "series_eligibility": _sales(
        f""", {_monthly('product')}, counts AS (SELECT product, count(*) FILTER (sale_month < DATE '{CUTOFF}') AS train_months,
        count(*) FILTER (sale_month >= DATE '{CUTOFF}') AS test_months FROM monthly GROUP BY product)
        SELECT *, train_months >= 12 AND test_months > 0 AS can_fit, train_months >= 12 AND test_months > 0 AND train_months + test_months >= 15 AS can_search FROM counts"""
    ),
    "naive_baselines": _sales(
        f""", {_QUARTERS} SELECT *, lag(quarter_total) {_BY_QUARTER} AS naive, lag(quarter_total, 4) {_BY_QUARTER} AS seasonal_naive,
        round(avg(quarter_total) OVER {_BEFORE}, 2) AS rolling_mean FROM quarters"""
    ),
    "quarter_features": _sales(
        f""", {_QUARTERS}, features AS (SELECT *, """
        + ", ".join(f"lag(quarter_total, {k}) {_BY_QUARTER} AS lag_{k}" for k in range(1, 5))
        + f""", round(avg(quarter_total) OVER {_BEFORE}, 4) AS mean_4, round(stddev_samp(quarter_total) OVER {_BEFORE}, 4) AS stddev_4 FROM quarters)
        SELECT * FROM features WHERE sale_quarter < DATE '{CUTOFF}'"""
    ),
    "backtest": _sales(_backtest()),
    "quarter_regression": _sales(_regression()),
    "trend_regression": _sales(
        f""", {_monthly('region, type')}, points AS (SELECT region, type, year(sale_month) * 12 + month(sale_month) AS t, CAST(revenue AS DECIMAL(18,2)) AS y FROM monthly),
        sums AS (SELECT region, type, CAST(count(*) AS DOUBLE) AS n, CAST(max(t) AS DOUBLE) AS last, CAST(sum(t) AS DOUBLE) AS st, CAST(sum(y) AS DOUBLE) AS sy,
          CAST(sum(t * t) AS DOUBLE) AS stt, CAST(sum(CAST(CAST(t AS DECIMAL(9,0)) * y AS DECIMAL(28,2))) AS DOUBLE) AS sty, CAST(sum(CAST(CAST(y AS DECIMAL(19,2)) * CAST(y AS DECIMAL(19,2)) AS DECIMAL(36,4))) AS DOUBLE) AS syy
          FROM points GROUP BY ALL),
        moments AS (SELECT *, stt - st * st / n AS sxx, sty - st * sy / n AS sxy, syy - sy * sy / n AS vyy FROM sums WHERE n > 2),
        fitted AS (SELECT *, sxy / sxx AS slope, sy / n + sxy / sxx * (last + 1 - st / n) AS ahead,
          {fixed.CONFIDENCE_Z} * sqrt(greatest(vyy - sxy / sxx * sxy, 0) / (n - 2)) * sqrt(1 + 1 / n + (last + 1 - st / n) ** 2 / sxx) AS margin FROM moments)
        SELECT region, type, CAST(n AS BIGINT) AS months, round(slope, 4) AS slope, round(ahead, 2) AS next_value,
        round(ahead - margin, 2) AS next_lower, round(ahead + margin, 2) AS next_upper FROM fitted"""
    ),
    "forecast_by_customer": _sales(
        f""", {_pairs('customer')}, errors AS (SELECT customer, round(avg(abs(actual - predicted) / nullif(abs(actual), 0)) * 100, 6) AS mape FROM pairs GROUP BY 1),
        places AS (SELECT customer, dense_rank() OVER (ORDER BY sum(usd_total) DESC) AS place FROM usd GROUP BY customer)
        SELECT b.*, CASE WHEN place <= 5 THEN 'Tier 1 - Top 5' WHEN place <= 20 THEN 'Tier 2 - Top 20' ELSE 'Tier 3 - Long Tail' END AS customer_tier,
        mape, CASE WHEN mape < 20 THEN 'High Confidence' WHEN mape < 50 THEN 'Moderate Confidence' ELSE 'Low Confidence' END AS confidence
        FROM baseline b JOIN places USING (customer) LEFT JOIN errors USING (customer)"""
    ),
    "activation_variance": _sales(
        f""", {_pairs('region, segment')} SELECT sale_month AS snapshot_month, region, segment, actual AS actual_revenue, predicted AS forecast_revenue,
        variance_pct, CAST(NULL AS DOUBLE) AS inventory_weeks_cover, CAST(NULL AS DOUBLE) AS market_index_score,
        CAST(NULL AS DOUBLE) AS activation_score,
        CASE WHEN variance_pct < -10 THEN 'activate' WHEN variance_pct > 10 THEN 'secure supply' ELSE 'hold' END AS recommended_action,
        CASE WHEN abs(variance_pct) < 20 THEN 'High Confidence' WHEN abs(variance_pct) < 50 THEN 'Moderate Confidence'
             ELSE 'Low Confidence' END AS confidence_note
        FROM (SELECT *, round((actual - predicted) / nullif(predicted, 0) * 100, 6) AS variance_pct FROM pairs)"""
    ),
    "run_metrics": _sales(
        f""", {_pairs('region, type')} SELECT '20001001T000000Z' AS forecast_run_id,
        CAST((SELECT max(sale_month) FROM pairs) AS TIMESTAMP) AS measured_until, 'region=' || region AS data_slice, count(*) AS points,
        round(avg(abs(actual - predicted) / nullif(abs(actual), 0)) * 100, 4) AS mape, round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,
        round(avg(CASE WHEN actual BETWEEN predicted * 0.5 AND predicted * 1.5 THEN 1.0 ELSE 0.0 END), 4) AS coverage FROM pairs GROUP BY region"""
    ),
    "seasonal_forecast": _sales(
        f""", {_monthly('region, type')}, past AS (SELECT * FROM monthly WHERE sale_month < DATE '{CUTOFF}'),
        spine AS (SELECT region, type, last_day(CAST(unnest(generate_series(CAST(date_trunc('month', min(sale_month)) AS DATE), max(sale_month), INTERVAL 1 MONTH)) AS DATE)) AS sale_month
          FROM past GROUP BY region, type),
        full_ AS (SELECT region, type, sale_month, coalesce(CAST(quantity AS DOUBLE), 0) AS quantity,
          coalesce(CAST(CAST(revenue AS DECIMAL(24,4)) AS DOUBLE), 0) AS revenue FROM spine LEFT JOIN past USING (region, type, sale_month)),
        steps AS (SELECT *, quantity - lag(quantity, 12) OVER w AS dq, revenue - lag(revenue, 12) OVER w AS dr FROM full_
          WINDOW w AS (PARTITION BY region, type ORDER BY sale_month)),
        fits AS (SELECT region, type, max(sale_month) AS last, avg(dq) AS dq, avg(dr) AS dr, avg(quantity) AS mq, avg(revenue) AS mr,
          {fixed.CONFIDENCE_Z} * stddev_samp(dr) AS margin FROM steps GROUP BY ALL),
        ahead AS (SELECT *, last_day(last + INTERVAL 1 MONTH * unnest([1, 2, 3])) AS forecast_date FROM fits),
        made AS (SELECT a.region, a.type, forecast_date, greatest(coalesce(f.quantity + a.dq, mq), 0) AS q, greatest(coalesce(f.revenue + a.dr, mr), 0) AS r, margin
          FROM ahead a LEFT JOIN full_ f ON f.region = a.region AND f.type = a.type AND last_day(f.sale_month + INTERVAL 12 MONTH) = forecast_date)
        SELECT region, type, forecast_date, round(q, 4) AS forecast_quantity, round(r, 4) AS forecast_revenue,
          round(CASE WHEN margin IS NOT NULL THEN greatest(r - margin, 0) END, 4) AS forecast_revenue_lower, round(r + margin, 4) AS forecast_revenue_upper FROM made"""
    ),
    "forecast_mart": _sales(
        f""", {_monthly('product')}, {_baseline('product')}, kinds AS (SELECT product, last_day(inv_date) AS sale_month, min(type) AS kind FROM usd GROUP BY ALL)
        SELECT '20001001T000000Z' AS forecast_run_id, 'all' AS cohort, 'baseline' AS model_name, 'rolling_mean_v1' AS model_version,
        b.product AS sku, 'all' AS channel, forecast_date AS sale_month, forecast_date, forecast_quantity, forecast_revenue,
        CAST(quantity AS DOUBLE) AS actual_quantity, CAST(revenue AS DOUBLE) AS actual_revenue, m.product AS product_name, kind AS product_type,
        kind AS product_subcategory, CAST(NULL AS DOUBLE) AS forecast_revenue_lower, CAST(NULL AS DOUBLE) AS forecast_revenue_upper
        FROM baseline b LEFT JOIN monthly m ON b.product = m.product AND forecast_date = m.sale_month
        LEFT JOIN kinds k ON k.product = m.product AND k.sale_month = m.sale_month"""
    ),
}
