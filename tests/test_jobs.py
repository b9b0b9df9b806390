import datetime as dt

import pytest

from ledgerline.plans import jobs

HEADER = "PI,Customer,ItemCode,Product,Quantity,Price,Total,Currency,InvDate,Country\n"


@pytest.fixture(scope="module")
def sheets(tmp_path_factory):
    """Two years of monthly sales: one rack server, two services."""
    folder = tmp_path_factory.mktemp("sheets")
    months = [dt.date(2023 + m // 12, m % 12 + 1, 15) for m in range(24)]
    for year in (2023, 2024):
        hardware = [d for d in months if d.year == year]
        body = "".join(f"H{d},Acme,RS1,RS1221+,{3 + d.month % 4},100,{100 * (3 + d.month % 4)},USD,{d},Peru\n" for d in hardware)
        (folder / f"{year}.csv").write_text(HEADER + body)
        service = "".join(
            f"S{d}{c},{c},,C2 Backup Business 1T,1,10,10,EUR,{d},Chile\n"
            for d in hardware for c in ("Acme", "Bolt") if c == "Acme" or d.month % 2
        )
        (folder / f"{year}-S.csv").write_text(HEADER + service)
    return str(folder)


@pytest.fixture(scope="module")
def cleaned(spark, sheets, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("clean") / "export")
    regions = spark.createDataFrame([("Peru", "South")], "Country string, Region string")
    suites = {"hardware": ["2023", "2024"], "service": ["2023-S", "2024-S"], "none": ["x"]}
    return jobs.clean_sheets(spark, sheets, out, suites=suites, country_regions=regions), out


def test_clean_sheets(spark, cleaned):
    df, out = cleaned
    assert df.count() == 24 + 24 + 12
    assert {r.Region for r in df.select("Region").distinct().collect()} == {"South"}
    counts = {r.suite: r["count"] for r in spark.read.parquet(f"{out}_suites").groupBy("suite").count().collect()}
    assert counts == {"hardware": 24, "service": 36}


def test_marts(spark, cleaned, tmp_path):
    marts = jobs.subscription_marts(jobs.subscription_lines(cleaned[0]))
    assert len(jobs.publish_marts(spark, marts, str(tmp_path))) == 8
    churn = spark.read.parquet(str(tmp_path / "logo_churn")).orderBy("snapshot_month").collect()
    assert len(churn) == 23
    # Bolt buys in odd months only, and the year ends on an even one.
    assert [(r.new_logos, r.churned_logos) for r in churn[:3]] == [(0, 1), (1, 0), (0, 1)]
    totals = spark.read.option("header", True).csv(str(tmp_path / "csv" / "subscription_totals")).collect()
    assert float(totals[0].mrr_total) == 21.0


def test_baseline_run_and_idempotent_load(spark, cleaned, sheets, tmp_path):
    out, mart = str(tmp_path / "runs"), str(tmp_path / "mart")
    for run in ("20240901T000000Z", "20241001T000000Z"):
        jobs.train_baseline(spark, out, run, cleaned[1], sheets)
    actuals = spark.createDataFrame(
        [(dt.date(2024, 11, 30), "RS1", 6.0, 600.0, "RS1221+")],
        "sale_month date, sku string, actual_quantity double, actual_revenue double, product_name string",
    )
    for _ in range(2):
        assert jobs.load_forecast(spark, out, "baseline", mart, "all", "baseline", "v1", actuals)
    rows = spark.read.parquet(mart).filter("sku = 'RS1' and channel = '2024'").orderBy("forecast_date").collect()
    assert [str(r.forecast_date) for r in rows] == ["2024-11-30", "2024-12-31", "2025-01-31"]
    assert {r.forecast_run_id for r in rows} == {"20241001T000000Z"}
    assert (rows[0].actual_revenue, rows[0].product_name, rows[1].actual_revenue) == (600.0, "RS1221+", None)
    assert not jobs.load_forecast(spark, str(tmp_path / "nothing"), "baseline", mart, "all", "b", "v1")


def test_cohort_forecast(spark, cleaned, tmp_path):
    out = str(tmp_path)
    made = jobs.train_cohort(cleaned[0], out, "r1", "rack", ["2023", "2024"])
    assert made.forecast.count() == 3
    combined = made.combined.orderBy("sale_month").collect()
    assert len(combined) == 24 and sum(r.forecast_revenue is not None for r in combined) == 3
    assert made.metrics.collect()[0].mape >= 0
    assert jobs.load_forecast(spark, out, "rack", f"{out}/mart", "rack", "arima", "v1")
    loaded = spark.read.parquet(f"{out}/mart")
    assert loaded.count() == 24 and {r.sku for r in loaded.select("sku").distinct().collect()} == {"RACK_ALL"}
    assert loaded.filter("actual_revenue is not null").count() == 24
    with pytest.raises(ValueError, match="months before"):
        jobs.train_cohort(cleaned[0], out, "r2", "rack", holdout="2020-01-01")


def test_quarterly_frames(spark, cleaned):
    train, test, _ = jobs.quarterly_training_frames(spark, cleaned[1], segments=("Type",), date="InvDate")
    assert (train.count(), test.count()) == (14, 2)
    focus = ("Type", ["SERVER"])
    train, test, _ = jobs.quarterly_training_frames(spark, cleaned[1], segments=("Type",), date="InvDate", focus=focus)
    assert (train.count(), test.count()) == (7, 1)
