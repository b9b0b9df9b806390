import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import forecast


def monthly(spark, values, key="a", start="2022-01-31"):
    months = pd.date_range(start, periods=len(values), freq="ME")
    rows = [(key, m.date(), float(v), float(v) * 10) for m, v in zip(months, values)]
    return spark.createDataFrame(rows, "k string, sale_month date, quantity double, revenue double")


def test_baseline_starts_after_the_cutoff_month(spark):
    df = monthly(spark, [1, 2, 3, 4, 5], start="2024-06-30")  # June to October
    got = forecast.baseline_forecast(df, ["k"], "2024-10-01").orderBy("forecast_date").collect()
    assert [str(r.forecast_date) for r in got] == ["2024-11-30", "2024-12-31", "2025-01-31"]
    assert {r.forecast_quantity for r in got} == {3.0}  # July to September
    early = forecast.baseline_forecast(df, ["k"], "2024-10-01", skip_cutoff_month=False)
    assert min(str(r.forecast_date) for r in early.collect()) == "2024-10-31"


def test_errors_skip_zero_actuals(spark):
    df = spark.createDataFrame([("a", 0.0, 5.0), ("a", 10.0, 5.0), ("a", 4.0, 5.0)], "k string, actual double, predicted double")
    a, p = F.col("actual"), F.col("predicted")
    assert forecast.mape(df, ["k"], forecast.ape(a, p)).collect()[0].mape == pytest.approx(37.5)
    floored = forecast.mape(df, ["k"], forecast.ape_floor_one(a, p)).collect()[0].mape
    assert floored == pytest.approx((5 + 0.5 + 0.25) / 3 * 100)
    m = forecast.metrics(df, ["k"], band=0.5).collect()[0]
    assert (m.points, m.wape) == (3, pytest.approx(11 / 14 * 100))
    assert m.rmse == pytest.approx(np.sqrt((25 + 25 + 1) / 3)) and m.coverage == pytest.approx(1 / 3)


def test_actuals_fill_only_absent_columns(spark):
    f = spark.createDataFrame([("a", 1, 9.0), ("b", 1, 8.0)], "sku string, m int, x double")
    act = spark.createDataFrame([("a", 1, 1.0, 2.0)], "sku string, month int, x double, y double")
    got = {r.sku: (r.x, r.y) for r in forecast.add_actuals(f, act, {"sku": "sku", "m": "month"}).collect()}
    assert got == {"a": (9.0, 2.0), "b": (8.0, None)}


def test_trend_is_exact_on_a_line(spark):
    row = forecast.trend(monthly(spark, [10, 12, 14, 16]), ["k"], "sale_month", "quantity").collect()[0]
    assert (row.slope, row.next_value, row.next_lower, row.next_upper) == (2.0, 18.0, 18.0, 18.0)


def test_eligibility(spark):
    df = monthly(spark, range(14)).unionByName(monthly(spark, range(16), "b")).unionByName(monthly(spark, range(5), "c"))
    got = {r.k: (r.can_fit, r.can_search) for r in forecast.eligibility(df, ["k"], "2023-02-01").collect()}
    assert got == {"a": (True, False), "b": (True, True), "c": (False, False)}


def test_confidence(spark):
    df = spark.createDataFrame([(19.9,), (20.0,), (50.0,)], "m double")
    assert [r[0].split()[0] for r in df.select(forecast.confidence(F.col("m"))).collect()] == ["High", "Moderate", "Low"]


def test_only_eligible_series_stay(spark):
    df = monthly(spark, range(16), "b").unionByName(monthly(spark, range(5), "c"))
    flags = forecast.eligibility(df, ["k"], "2023-02-01")
    assert {r.k for r in forecast.only_eligible(df, flags, ["k"]).collect()} == {"b"}


def test_seasonal_forecast_repeats_season_and_growth(spark):
    wave = [100 + 10 * (t % 12) + t for t in range(36)]
    df = monthly(spark, wave, "long", "2019-01-31").unionByName(monthly(spark, [3, 6, 9], "short"))
    got = {}
    for r in forecast.seasonal_forecast(df, ["k"], 3).orderBy("forecast_date").collect():
        got.setdefault(r.k, []).append(r)
    assert [r.forecast_quantity for r in got["long"]] == pytest.approx([100 + 10 * (t % 12) + t for t in (36, 37, 38)])
    assert got["long"][0].forecast_date == dt.date(2022, 1, 31)
    assert all(r.forecast_revenue_lower == pytest.approx(r.forecast_revenue_upper) for r in got["long"])
    assert [r.forecast_quantity for r in got["short"]] == [6.0] * 3 and got["short"][0].forecast_revenue_upper is None
    with pytest.raises(ValueError, match="season"):
        forecast.seasonal_forecast(df, ["k"], 13)
