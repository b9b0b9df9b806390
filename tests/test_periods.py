import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import periods
from ledgerline.operators import periodic

D = dt.date


@pytest.fixture()
def lines(spark):
    rows = [
        (D(2024, 1, 10), 100.0, "A"), (D(2024, 2, 5), 50.0, "A"), (D(2024, 4, 1), 75.0, "A"),
        (D(2024, 1, 20), 20.0, "B"), (D(2024, 5, 9), 30.0, "B"), (D(2024, 6, 30), 5.0, "B"),
    ]
    return spark.createDataFrame(rows, "invoice_date date, usd_adjusted_total double, Type string")


def test_quarter_totals(lines):
    out = periodic.quarterly_totals(lines, "usd_adjusted_total", ("Type",)).orderBy("Type", "sale_quarter")
    assert [tuple(r) for r in out.collect()] == [
        ("A", D(2024, 1, 1), 150.0, D(2024, 1, 1), D(2024, 3, 31)),
        ("A", D(2024, 4, 1), 75.0, D(2024, 4, 1), D(2024, 6, 30)),
        ("B", D(2024, 1, 1), 20.0, D(2024, 1, 1), D(2024, 3, 31)),
        ("B", D(2024, 4, 1), 35.0, D(2024, 4, 1), D(2024, 6, 30)),
    ]


def test_gaps_cover_observed_combinations_and_the_global_range(spark):
    rows = [(D(2023, 1, 1), 1.0, "A", "x"), (D(2023, 9, 1), 2.0, "B", "y"), (D(2023, 9, 1), None, None, "y")]
    df = spark.createDataFrame(rows, "sale_date date, v double, s string, t string")
    out = periodic.quarterly_totals(df, "v", ("s", "t"))
    got = {(r.s, r.t, r.sale_quarter.month): r.quarter_total for r in out.collect()}
    assert len(got) == 3 * 3
    assert got[("A", "x", 1)] == 1.0 and got[("A", "x", 4)] == 0.0 and got[("Unknown", "y", 7)] == 0.0
    levels = {"s": ["A", "B", "Unknown"], "t": ["x", "y"]}
    full = periodic.quarterly_totals(df, "v", ("s", "t"), levels=levels)
    assert {(r.s, r.t, r.sale_quarter.month) for r in full.collect()} > set(got) and full.count() == 3 * 2 * 3
    alone = periodic.quarterly_totals(df, "v")
    assert [r.quarter_total for r in alone.orderBy("sale_quarter").collect()] == [1.0, 0.0, 2.0]


def test_missing_columns_are_named(spark, lines):
    with pytest.raises(ValueError, match="date column"):
        periodic.quarterly_totals(spark.createDataFrame([(1,)], "usd_adjusted_total long"), "usd_adjusted_total")
    with pytest.raises(ValueError, match="nope"):
        periodic.quarterly_totals(lines, "nope")
    with pytest.raises(ValueError, match="zzz"):
        periodic.require_columns(lines, ["Type", "zzz"])


def test_date_candidates_skip_empty_columns(spark):
    df = spark.createDataFrame([("bad", "2024-01-01")], "Date string, order_date string")
    assert periodic.resolve_date(df) == "order_date"


def test_split_latest(lines):
    quarters = periodic.quarterly_totals(lines, "usd_adjusted_total", ("Type",))
    train, test, latest = periodic.split_latest(quarters)
    assert {r.sale_quarter for r in train.collect()} == {D(2024, 1, 1)}
    assert {r[0] for r in test.select(latest).collect()} == {D(2024, 4, 1)}
    periodic.require_split(train, test)
    with pytest.raises(ValueError, match="quarters"):
        periodic.require_split(train.limit(0), test)


def test_focus_flag_and_views(lines):
    tagged = periodic.tag_focus(lines, "Type", ["A"])
    assert {(r.Type, r.is_focus_product) for r in tagged.collect()} == {("A", True), ("B", False)}
    everything, focus = periodic.quarterly_views(lines, "usd_adjusted_total", "Type", ["A"], ("Type",))
    assert {r.Type for r in focus.collect()} == {"A"}
    assert {r.is_focus_product for r in everything.collect()} == {True, False}
    with pytest.raises(ValueError, match="empty"):
        periodic.tag_focus(lines, "Type", [])


def test_month_gaps(spark):
    rows = [("a", D(2024, 1, 31), 1.0), ("a", D(2024, 4, 30), 2.0), ("b", D(2024, 2, 29), 3.0)]
    df = spark.createDataFrame(rows, "k string, sale_month date, q double")
    out = periodic.fill_month_gaps(df, ["q"], ["k"]).orderBy("k", "sale_month").collect()
    assert [(r.k, r.sale_month.month, r.q) for r in out] == [
        ("a", 1, 1.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 2.0), ("b", 2, 3.0),
    ]


def test_calendar(spark):
    row = spark.range(1).select(
        periods.future_month_ends(F.lit("2024-01-31").cast("date"), 3),
        periods.quarter_end(F.lit("2024-05-05").cast("date")),
        periods.fiscal_year(F.lit("2024-03-31").cast("date")),
        periods.fiscal_year(F.lit("2024-04-01").cast("date")),
    ).collect()[0]
    assert row[0] == [D(2024, 2, 29), D(2024, 3, 31), D(2024, 4, 30)]
    assert row[1] == D(2024, 6, 30) and (row[2], row[3]) == (2024, 2025)
