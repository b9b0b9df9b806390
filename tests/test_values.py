"""Values that must survive: small rates, many decimals, odd blanks, odd dates, credits, bad cells."""

import datetime as dt
import re

from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fixed
from ledgerline.functions import numbers, periods, text
from ledgerline.operators import clean, enrich, quality, subscription
from ledgerline.sources import writers
from ledgerline.streaming import incremental


def one(df):
    return df.collect()[0]


def test_small_rates_keep_their_digits(spark):
    lines = spark.createDataFrame([("IDR", 1000.0, 123.4567), ("XXX", 1.0, 1.0)], "Currency string, Price double, Total double")
    rates = {"IDR": "0.0000615", "VND": "0.000039", "USD": "1"}
    got = {r.Currency: r for r in enrich.convert_currency(lines, rates=rates).collect()}
    assert float(got["IDR"].usd_adjusted_price) == 0.0615
    assert abs(float(got["IDR"].usd_adjusted_total) - 123.4567 * 0.0000615) < 1e-12
    assert abs(float(got["XXX"].exchange_rate_to_usd) - (0.0000615 + 0.000039 + 1) / 3) < 1e-8


def test_decimals_of_staged_numbers(spark):
    df = spark.createDataFrame([("1.2345", "2.999", "-1", "1e3")], "a string, b string, c string, d string")
    row = one(df.select(*[numbers.plain_decimal(F.col(c)).alias(c) for c in df.columns]))
    assert [None if x is None else float(x) for x in row] == [1.2345, 2.999, 0.0, None]


def test_unicode_blanks(spark):
    df = spark.createDataFrame([("\u2003Acme\xa0",), ("\xa0\u3000",), ("a\xa0b",)], "Customer string")
    assert [r[0] for r in clean.normalise_missing(df).collect()] == ["Acme", None, "a\xa0b"]
    strict = clean.normalise_missing(df, strict=True)
    assert [r[0] for r in strict.collect()] == ["Acme", None, "a\xa0b"]
    assert one(df.select(text.null_if_blank(F.lit("\u202f")))) [0] is None


def test_dates_in_several_formats(spark):
    cells = ["2024-01-15", "2024/01/15", "01/15/2024", "15-Jan-2024", "20240115", "2024-01-15 10:11:12", " 2024-1-15 "]
    df = spark.createDataFrame([(c,) for c in cells], "d string")
    assert {r[0] for r in df.select(periods.any_date(F.col("d"))).collect()} == {dt.date(2024, 1, 15)}
    bad = spark.createDataFrame([("2024-13-45",), ("15/01/2024",), ("soon",), ("",), (None,)], "d string")
    assert {r[0] for r in bad.select(periods.any_date(F.col("d"))).collect()} == {None}


def test_only_texts_of_a_format_reach_its_parser(spark):
    """a parser that fails throws and catches an error, many times slower than a look at the shape."""
    cells = [
        "2024/01/15", "01/15/2024", "15-Jan-2024", "15-jan-2024", "20240115", " 2024-1-15 ", "1996/09", "1996/09/01", "-2024/01/15", "01/15/-2024",
        "2024/1/5", "15-January-2024", "15-Sept-2024", "120240115", "2024/02/30", "1/2/2024", "2024/01/15\n", "+2024", "--", "//", "",
    ]
    text = F.btrim(F.col("d"))
    parsers = [F.try_to_timestamp(text, F.lit(form)).cast("date") for form in fixed.DATE_FORMATS]
    plain = F.coalesce(F.when(text.rlike(fixed.ISO_START), text.try_cast("date")), *parsers)
    shaped = periods.any_date(F.col("d"))
    df = spark.createDataFrame([(c,) for c in cells], "d string")
    assert [r[0] for r in df.select(shaped.cast("string")).collect()] == [r[0] for r in df.select(plain.cast("string")).collect()]
    assert set(fixed.DATE_SHAPES) == set(fixed.DATE_FORMATS)
    plan = df.select(shaped.alias("day"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN RLIKE") == 1 + len(fixed.DATE_FORMATS)


def test_lines_without_an_order_number_are_one_order(spark):
    rows = [(dt.date(2024, 1, 5), o, "a", "C2 Backup", "SUB-A-S-B", "r", "c", 1.0, 1.0) for o in ("x", None, None)]
    names = "inv_date date, order_id string, customer string, product string, code string, region string, country string, quantity double, usd_total double"
    card = subscription.adoption_scorecard(subscription.subscription_lines(spark.createDataFrame(rows, names)))
    assert one(card).new_subscriptions == 2


def test_churn_with_credits(spark):
    def paid(month, customer, revenue):
        return (dt.date(2024, month, 28), customer, "f", revenue)

    rows = [paid(1, "a", 10), paid(2, "a", 10), paid(2, "b", -4), paid(3, "a", 10)]
    df = spark.createDataFrame(rows, "month date, customer string, family string, revenue int")
    df = df.withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    got = {r.snapshot_month.month: r for r in subscription.revenue_churn(df).collect()}
    assert (got[2].kept_revenue, got[2].expansion_revenue, got[2].churned_revenue, got[2].net_change) == (6, 0, 4, -4)
    assert (got[3].kept_revenue, got[3].expansion_revenue, got[3].churned_revenue, got[3].net_change) == (6, 4, 0, 4)


def test_manifest_sees_repeated_rows_and_shifted_nulls(spark):
    def content(*rows):
        return one(quality.manifest(spark.createDataFrame(list(rows), "s string, a string, b string"), "s")).content_hash

    assert content(("s", "x", "y")) != content(("s", "x", "y"), ("s", "x", "y"), ("s", "x", "y"))
    assert content(("s", None, "x")) != content(("s", "x", None)) != content(("s", "x", "-"))
    assert content(("s", "a|1:b", None)) != content(("s", "a", "b"))


def test_one_bad_cell_does_not_stop_a_load(spark):
    rows = [("a", "2024-05-03", "1.5", "oops"), ("b", "soon", "2", "3"), ("c", "2024-05-04", "bad", "4")]
    df = spark.createDataFrame(rows, "sku string, forecast_date string, forecast_quantity string, actual_revenue string")
    got = {r.sku: r for r in writers.prepare_forecast(df, "all", "r", "m", "v").collect()}
    assert set(got) == {"a", "c"} and got["a"].forecast_quantity == 1.5 and got["a"].actual_revenue is None
    assert got["c"].forecast_quantity is None and got["c"].sale_month == dt.date(2024, 5, 31)


def test_marts_keep_lines_without_a_month_and_survive_an_empty_batch(spark, tmp_path):
    source, states, mart, state = (str(tmp_path / n) for n in ("in", "states", "mart", "state"))
    names = "month date, amount double"

    def put(name, rows):
        spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{source}/{name}")

    def run():
        stream = incremental.named_snapshots(incremental.snapshot_stream(spark, source, spark.createDataFrame([], names).schema))
        incremental.maintain_months(stream, states, mart, state, lambda df: df.filter("amount > 0"), (), {"amount": F.sum("amount")})

    put("none", [(dt.date(2024, 1, 31), -1.0)])
    run()
    put("some", [(None, 2.0), (dt.date(2024, 1, 31), 3.0)])
    run()
    put("more", [(None, 5.0)])
    run()
    assert {(r.month, r.amount) for r in incremental.month_mart(spark, mart).collect()} == {(None, 7.0), (dt.date(2024, 1, 31), 3.0)}


def test_cleaning_has_one_plan_for_few_and_many_names(spark):
    def plan(n):
        rows = spark.range(n).select(F.concat(F.lit("RS"), "id").alias("Product"), *[
            F.lit(v).alias(c) for c, v in {"Customer": "a", "Quantity": "1", "Price": "2", "Total": "3", "Currency": "USD",
                                             "InvDate": "2024-01-01", "Country": "Peru", "Region": "South"}.items()])
        shown = clean.clean_sales(rows)
        return [re.split(r"[(\[]", p)[0].strip(" +-:*") for p in shown._jdf.queryExecution().optimizedPlan().toString().splitlines()
                if "Join" in p or "Aggregate" in p], shown.columns

    assert plan(3) == plan(3000)
