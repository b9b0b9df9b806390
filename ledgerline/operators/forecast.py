"""Closed-form forecasts and their evaluation, over monthly and quarterly series."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.numbers import ratio
from ..functions.periods import future_month_ends, month_number
from .series import tail_mean

MEASURES = ("quantity", "revenue")


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def baseline_forecast(
    monthly: DataFrame,
    keys: Sequence[str],
    cutoff: str = fixed.HOLDOUT_START,
    horizon: int = fixed.HORIZON_MONTHS,
    window: int = fixed.ROLLING_WINDOW,
    skip_cutoff_month: bool = True,
) -> DataFrame:
    """Mean of the last observed months before the cutoff, repeated per future month.

    The cutoff moves to its month end and forecasts start a month later, unless
    ``skip_cutoff_month`` is off. Months count as observed, not as calendar months.
    """
    edge = F.last_day(day(cutoff))
    tails = tail_mean(monthly.filter(F.col("sale_month") < edge), keys, "sale_month", MEASURES, window)
    start = edge if skip_cutoff_month else F.add_months(edge, -1)
    return (
        tails.withColumn("forecast_date", F.explode(future_month_ends(start, horizon)))
        .filter(F.col("forecast_date") > F.col("last_period"))
        .select(
            *keys,
            "forecast_date",
            F.col("quantity_mean").alias("forecast_quantity"),
            F.col("revenue_mean").alias("forecast_revenue"),
        )
    )


def backtest(
    monthly: DataFrame, keys: Sequence[str], cutoffs: Sequence[str], horizon: int, window: int
) -> DataFrame:
    """The baseline at several cutoffs, next to what happened.

    Each month is handed to the cutoffs it precedes; the tail cut happens before
    the shuffle, so the copies do not travel.
    """
    points = F.array(*[day(c) for c in cutoffs])
    later = F.filter(points, lambda c: F.col("sale_month") < F.last_day(c))
    train = monthly.withColumn("cutoff", F.explode(later))
    tails = tail_mean(train, [*keys, "cutoff"], "sale_month", MEASURES, window)
    ends = future_month_ends(F.last_day("cutoff"), horizon)
    future = tails.select(
        *keys, "cutoff", F.explode(ends).alias("sale_month"), F.col("revenue_mean").alias("forecast_revenue")
    )
    return future.join(monthly.select(*keys, "sale_month", "revenue"), [*keys, "sale_month"], "left")


def add_actuals(forecast: DataFrame, actuals: DataFrame, on: dict[str, str]) -> DataFrame:
    """Forecast rows with the columns of ``actuals`` they do not have yet."""
    added = [c for c in actuals.columns if c not in forecast.columns and c not in on.values()]
    renamed = actuals.select(*[F.col(a).alias(f"_{a}") for a in on.values()], *added)
    tests = [forecast[f] == renamed[f"_{a}"] for f, a in on.items()]
    return forecast.join(renamed, tests, "left").select(*forecast.columns, *added)


def combine(actuals: DataFrame, forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Actual and forecast values on the union of their months."""
    dated = forecast.withColumnRenamed("forecast_date", "sale_month")
    return actuals.join(dated, [*keys, "sale_month"], "full")


# --- error measures ------------------------------------------------------------------


def ape(actual: Column, predicted: Column) -> Column:
    """Absolute percentage error, null where the actual value is 0."""
    return F.when(F.abs(actual) > 0, F.abs(actual - predicted) / F.abs(actual))


def ape_floor_one(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted) / F.greatest(actual, F.lit(1.0))


def mape(pairs: DataFrame, keys: Sequence[str], error: Column, name: str = "mape") -> DataFrame:
    return pairs.groupBy(*keys).agg((F.avg(error) * 100).alias(name))


def metrics(pairs: DataFrame, keys: Sequence[str], band: float | None = None) -> DataFrame:
    """Error measures per cohort from ``actual`` and ``predicted``, in one aggregate.

    Coverage is taken from ``lower`` and ``upper``, or from a band around the
    prediction when ``band`` is given.
    """
    a, p = F.col("actual"), F.col("predicted")
    low, high = (p * (1 - band), p * (1 + band)) if band else (F.col("lower"), F.col("upper"))
    both = F.abs(a) + F.abs(p)
    return pairs.groupBy(*keys).agg(
        F.count("*").alias("points"),
        (F.avg(ape(a, p)) * 100).alias("mape"),
        (F.avg(F.try_divide(2 * F.abs(a - p), both)) * 100).alias("smape"),
        (F.try_divide(F.sum(F.abs(a - p)), F.sum(F.abs(a))) * 100).alias("wape"),
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        F.avg(F.when(a.between(low, high), 1.0).otherwise(0.0)).alias("coverage"),
    )


def rolling_rmse(pairs: DataFrame, keys: Sequence[str], quarter: str, quarters: int = 4) -> DataFrame:
    """Root mean square error of the last quarters, over quarter-grain errors."""
    error = F.col("actual") - F.col("predicted")
    grain = pairs.groupBy(*keys, quarter).agg(F.sum(error * error).alias("_sq"), F.count(error).alias("_n"))
    frame = Window.partitionBy(*keys).orderBy(quarter).rowsBetween(-(quarters - 1), 0)
    value = F.sqrt(F.try_divide(F.sum("_sq").over(frame), F.sum("_n").over(frame).cast("double")))
    return grain.select(*keys, quarter, value.alias("rolling_rmse"))


def over_limit(measured: DataFrame, limit: float, column: str = "mape") -> DataFrame:
    """Cohorts whose error exceeds a limit."""
    return measured.filter(F.col(column) > limit)


def confidence(mape_column: Column) -> Column:
    return (
        F.when(mape_column < fixed.HIGH_CONFIDENCE_MAPE, fixed.HIGH_CONFIDENCE)
        .when(mape_column < fixed.MODERATE_CONFIDENCE_MAPE, fixed.MODERATE_CONFIDENCE)
        .otherwise(fixed.LOW_CONFIDENCE)
    )


def eligibility(
    monthly: DataFrame, keys: Sequence[str], cutoff: str,
    train: int = fixed.MIN_TRAIN_MONTHS, total: int = fixed.MIN_SEARCH_MONTHS,
) -> DataFrame:
    """Which series have enough months to be fitted, and to be searched."""
    past = F.col("sale_month") < day(cutoff)
    counts = monthly.groupBy(*keys).agg(
        F.count_if(past).alias("train_months"), F.count_if(~past).alias("test_months")
    )
    fit = (F.col("train_months") >= train) & (F.col("test_months") > 0)
    search = fit & (F.col("train_months") + F.col("test_months") >= total)
    return counts.withColumns({"can_fit": fit, "can_search": search})


def only_eligible(series: DataFrame, flags: DataFrame, keys: Sequence[str], flag: str = "can_fit") -> DataFrame:
    """Rows of the series an :func:`eligibility` table admits."""
    return series.join(flags.filter(flag).select(*keys), list(keys), "left_semi")


# --- other baselines and features ---------------------------------------------------------


def naive_baselines(quarterly: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Last quarter, same quarter last year, and mean of the four before."""
    spec = Window.partitionBy(*keys).orderBy(order)
    before = spec.rowsBetween(-4, -1)
    total, n = F.sum(value).over(before), F.count(value).over(before)
    return quarterly.withColumns(
        {
            "naive": F.lag(value, 1).over(spec),
            "seasonal_naive": F.lag(value, 4).over(spec),
            "rolling_mean": ratio(total, n),
        }
    )


def quarter_features(
    quarterly: DataFrame, keys: Sequence[str], order: str, value: str, cutoff: str
) -> DataFrame:
    """Lags 1 to 4 and statistics of the quarters before, for quarters before the cutoff."""
    spec = Window.partitionBy(*keys).orderBy(order)
    before = spec.rowsBetween(-4, -1)
    lags = {f"lag_{k}": F.lag(value, k).over(spec) for k in range(1, 5)}
    mean = ratio(F.sum(value).over(before), F.count(value).over(before))
    return quarterly.withColumns({**lags, "mean_4": mean, "stddev_4": F.stddev(value).over(before)}).filter(
        F.col(order) < day(cutoff)
    )


def trend(monthly: DataFrame, keys: Sequence[str], month: str, value: str, z: float = fixed.CONFIDENCE_Z) -> DataFrame:
    """Straight line per series, its next month and a 95 % interval, unrounded.

    Everything comes from six sums per series, so map tasks combine before the
    shuffle. The sums are exact decimals.
    """
    t = month_number(F.col(month)).cast("decimal(9,0)")
    y = F.col(value).cast("decimal(18,2)")
    sums = monthly.groupBy(*keys).agg(
        F.count(y).cast("double").alias("n"),
        F.max(t).cast("double").alias("last"),
        F.sum(t).cast("double").alias("st"),
        F.sum(y).cast("double").alias("sy"),
        F.sum(t * t).cast("double").alias("stt"),
        F.sum((t * y).cast("decimal(28,2)")).cast("double").alias("sty"),
        F.sum((y * y).cast("decimal(36,4)")).cast("double").alias("syy"),
    )
    n, st, sy = F.col("n"), F.col("st"), F.col("sy")
    sxx = F.col("stt") - st * st / n
    sxy = F.col("sty") - st * sy / n
    lines = sums.filter(n > 2).withColumns({"sxx": sxx, "slope": F.try_divide(sxy, sxx), "_syy": F.col("syy") - sy * sy / n, "_sxy": sxy})
    ahead = F.col("last") + 1
    mean_t = st / n
    residual = F.sqrt(F.greatest(F.col("_syy") - F.col("slope") * F.col("_sxy"), F.lit(0.0)) / (n - 2))
    margin = z * residual * F.sqrt(1 + 1 / n + (ahead - mean_t) * (ahead - mean_t) / F.col("sxx"))
    value_ahead = sy / n + F.col("slope") * (ahead - mean_t)
    return lines.select(
        *keys,
        n.cast("bigint").alias("months"),
        "slope",
        value_ahead.alias("next_value"),
        (value_ahead - margin).alias("next_lower"),
        (value_ahead + margin).alias("next_upper"),
    )


def seasonal_forecast(
    monthly: DataFrame, keys: Sequence[str], horizon: int = fixed.HORIZON_MONTHS, season: int = 12,
    z: float = fixed.CONFIDENCE_Z,
) -> DataFrame:
    """The month a season ago plus the mean seasonal difference, with a 95 % interval of the revenue.

    Input is contiguous (:func:`periodic.fill_month_gaps`). The windows run over one series, which
    the calendar bounds; everything else is one aggregate per series. Differences come from exact
    sums. Without a whole season behind it a series repeats the mean of its months; an interval
    needs two differences. ``horizon`` is at most ``season``.
    """
    if not 0 < horizon <= season:
        raise ValueError("horizon must be between 1 and the season")
    series = Window.partitionBy(*keys).orderBy("sale_month")
    whole = Window.partitionBy(*keys)
    known = monthly.select(*keys, "sale_month", *[F.col(m).cast("decimal(24,4)").alias(m) for m in MEASURES])
    known = known.withColumns({f"_{m}": F.col(m) - F.lag(m, season).over(series) for m in MEASURES})
    known = known.withColumn("_last", F.max("sale_month").over(whole))
    sums = [f(F.col(m)).cast("double").alias(f"_{name}_{m}") for m in MEASURES for name, f in (("sum", F.sum),)]
    steps = [F.sum(f"_{m}").cast("double").alias(f"_step_{m}") for m in MEASURES]
    square = F.sum((F.col("_revenue") * F.col("_revenue")).cast("decimal(38,4)")).cast("double").alias("_squares")
    n = [F.count("*").cast("double").alias("_months"), F.count("_revenue").cast("double").alias("_pairs")]
    fitted = known.groupBy(*keys).agg(F.max("sale_month").alias("_last"), *n, *sums, *steps, square)
    ahead = future_month_ends(F.col("_last"), horizon)
    future = fitted.withColumn("forecast_date", F.explode(ahead))
    base = known.filter(F.col("sale_month") > F.add_months("_last", -season)).select(
        *keys, F.last_day(F.add_months("sale_month", season)).alias("forecast_date"), *MEASURES
    )
    joined = future.join(base, [*keys, "forecast_date"], "left")
    spread = F.col("_squares") - F.col("_step_revenue") * F.col("_step_revenue") / F.col("_pairs")
    margin = F.when(F.col("_pairs") > 1, z * F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("_pairs") - 1)))

    def value(m: str) -> Column:
        stepped = F.col(m).cast("double") + F.col(f"_step_{m}") / F.col("_pairs")
        return F.greatest(F.coalesce(F.when(F.col("_pairs") > 0, stepped), F.col(f"_sum_{m}") / F.col("_months")), F.lit(0.0))

    return joined.select(
        *keys, "forecast_date", value("quantity").alias("forecast_quantity"), value("revenue").alias("forecast_revenue"),
        F.greatest(value("revenue") - margin, F.when(margin.isNotNull(), 0.0)).alias("forecast_revenue_lower"),
        (value("revenue") + margin).alias("forecast_revenue_upper"),
    )
