import random

import pandas as pd
import pytest

from ledgerline.operators import series


@pytest.fixture(scope="module")
def rows():
    """One key holds a third of the rows; days hold from one row to many."""
    rng = random.Random(5)
    out = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        day = rng.choice([1, 1, 1, 2, 3, 9, 10, 20])
        value = float(rng.randrange(50)) if rng.random() < 0.4 else None
        out.append((key, day, i, value, float(rng.randrange(20))))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k string, day int, id long, v double, q double")


@pytest.fixture(scope="module")
def pdf(rows):
    return pd.DataFrame(rows, columns=["k", "day", "id", "v", "q"]).sort_values(["k", "day", "id"])


@pytest.fixture
def small_blocks(spark):
    """As many blocks as there are shuffle partitions, although the table is small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("width", [1, 2, 7])
def test_moving_average_over_blocks(small_blocks, table, pdf, width):
    out = series.moving_average(table, ["k"], ["day", "id"], "q", width, "ma").collect()
    want = pdf.assign(ma=pdf.groupby("k")["q"].transform(lambda s: s.rolling(width, min_periods=1).mean()))
    assert {r.id: pytest.approx(r.ma) for r in out} == dict(zip(want["id"], want["ma"]))
    assert len(out) == len(pdf)


def test_forward_fill_over_blocks(small_blocks, table, pdf):
    out = series.forward_fill(table, ["k"], ["day", "id"], "v").collect()
    want = pdf.groupby("k")["v"].ffill()
    expected = {i: None if pd.isna(v) else v for i, v in zip(pdf["id"], want)}
    assert {r.id: r.v for r in out} == expected


def test_one_key_and_one_day_make_many_blocks(small_blocks, spark):
    """Also rows that are equal in every column of the order, and a null key."""
    df = spark.range(3000).selectExpr("CAST(NULL AS STRING) AS k", "1 AS day", "id DIV 1500 AS same", "CAST(id AS DOUBLE) AS q")
    assert series.blocks(df, ["k"], ["day", "same"]).select("_block").distinct().count() > 8
    assert series.moving_average(df, ["k"], ["day", "q"], "q", 2, "ma").filter("q > 0 and ma <> q - 0.5").count() == 0
    gaps = df.selectExpr("k", "q", "CASE WHEN q IN (5, 700) THEN q END AS v")
    got = series.forward_fill(gaps, ["k"], ["q"], "v").groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {None: 5, 5.0: 695, 700.0: 2300}


def test_rolling_and_tail(spark):
    df = spark.createDataFrame([("a", m, float(m * m)) for m in range(1, 6)], "k string, m int, q double")
    got = {r.m: r.q_mean for r in series.rolling_mean(df, ["k"], "m", ["q"], 3).collect()}
    assert got == {1: 1.0, 2: 2.5, 3: pytest.approx(14 / 3), 4: pytest.approx(29 / 3), 5: pytest.approx(50 / 3)}
    tail = series.tail_mean(df, ["k"], "m", ["q"], 3).collect()[0]
    assert (tail.last_period, tail.q_mean) == (5, pytest.approx(50 / 3))


def test_autocorrelation(spark):
    values = [1.0, 3.0, 2.0, 5.0, 4.0, 6.0, 2.0, 1.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, m int, x double")
    x = pd.Series(values) - sum(values) / len(values)
    got = {r.lag: r.acf for r in series.autocorrelation(df, ["k"], "m", "x", 3).collect()}
    assert got == {k: pytest.approx(float((x * x.shift(k)).sum() / (x * x).sum())) for k in (1, 2, 3)}


def test_log_difference_floors_at_one(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 2.718281828459045)], "k string, m int, q double")
    got = [r.diff_1 for r in series.log_seasonal_diff(df, ["k"], "m", "q", 1).orderBy("m").collect()]
    assert got == [None, pytest.approx(1.0)]


def test_last_rows_are_cut_before_the_shuffle(table):
    plan = series.last_rows(table, ["k"], "id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
