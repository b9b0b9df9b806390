"""Order statistics, regression on several features, distinct-count sketches, date probe."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import periodic, quality, quantiles, regression


@pytest.mark.parametrize("few", [3, 200])
def test_quantiles_by_rounds(spark, monkeypatch, few):
    """Intervals of a few rows at last, so that several rounds of cuts are needed; a hot key, ties, far values, a missing key."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "CUTS", 3)
    draw = random.Random(few)
    groups = {
        "hot": [draw.gauss(0, 1) for _ in range(1500)],
        "ties": [float(draw.choice([1, 1, 1, 1, 7])) for _ in range(400)],
        "far": [10.0 ** draw.randrange(-200, 200) * draw.choice([-1, 1]) for _ in range(300)],
        "one": [4.0],
        "two": [1.0, 2.0],
        None: [float(i) for i in range(50)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("none", None), ("hot", None)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {r.k: r for r in quantiles.quantiles(df, ["k"], "v", shares).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert (got[k].n, got[k].lowest, got[k].highest) == (len(vs), min(vs), max(vs))
        assert got[k].q == pytest.approx([float(np.quantile(vs, s)) for s in shares], rel=1e-12, abs=1e-300)


def test_no_buffer_of_values_in_boxes(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "CAST(id * id AS DOUBLE) AS v")
    boxes = {r.k: r for r in quality.box_stats(df, "v", ["k"]).collect()}
    values = [float(i * i) for i in range(0, 1000, 2)]
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert (boxes[0].q1, boxes[0].q3) == (q1, q3)
    assert boxes[0].outliers == sum(not q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1) for v in values)
    assert quality.box_stats(df.filter("false"), "v", ["k"]).count() == 0


def test_regression_against_least_squares(spark):
    draw = np.random.default_rng(2)
    rows, features = [], ("a", "b", "c")
    for k in range(3):
        for _ in range(30 + k):
            x = np.round(draw.normal(size=3) * (1, 100, 5) + (0, 1000, 3), 3)
            rows.append((f"k{k}", *map(float, x), float(np.round(2 * x[0] - x[1] + 3 * x[2] + draw.normal(), 3))))
    rows += [("short", 1.0, 2.0, 3.0, 4.0)] * 3 + [("flat", float(i), 2.0 * i, float(i % 3), float(i)) for i in range(9)]
    gaps = [("k0", None, 1.0, 1.0, 1.0), ("k0", 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows + gaps, "k string, a double, b double, c double, y double")
    model = regression.fit(df, ["k"], features, "y")
    found = {r.k: r for r in model.collect()}
    told = {(r.k, r.a, r.b, r.c, r.y): r for r in regression.predict(df, model, ["k"], features).collect()}
    for k in ("k0", "k1", "k2"):
        x = np.array([r[1:4] for r in rows if r[0] == k])
        y = np.array([r[4] for r in rows if r[0] == k])
        design = np.column_stack([np.ones(len(x)), x])
        beta, *_ = np.linalg.lstsq(design, y, rcond=None)
        sigma = np.sqrt(((y - design @ beta) ** 2).sum() / (len(y) - 4))
        inverse = np.linalg.inv(design.T @ design)
        assert [found[k].intercept, *(found[k][f"coef_{c}"] for c in features), found[k].sigma] == pytest.approx([*beta, sigma], rel=1e-6)
        for row, line in zip([r for r in rows if r[0] == k], design):
            margin = 1.96 * sigma * np.sqrt(1 + line @ inverse @ line)
            got = told[row]
            assert (got.fitted, got.upper - got.fitted) == pytest.approx((line @ beta, margin), rel=2e-3)
    assert found["short"].sigma is None and found["short"].coef_a is None
    assert found["flat"].coef_a is None and told[("flat", 1.0, 2.0, 1.0, 1.0)].fitted is None
    assert told[gaps[0]].fitted is None and told[gaps[1]].fitted is not None


def test_sketches_of_days_merge(spark):
    df = spark.range(30_000).selectExpr("id % 10 AS day", "id % 7000 AS many", "id % 5 AS few", "CAST(NULL AS STRING) AS none")
    stored = quality.distinct_sketches(df, ["day"], ["many", "few", "none"])
    merged = quality.merge_sketches(stored.withColumn("all", F.lit(1)), ["all"])
    got = {r.column_name: (r.rows, r.n) for r in merged.withColumn("n", quality.distinct_estimate(F.col("sketch"))).collect()}
    assert got["few"] == (30_000, 5) and got["none"] == (0, 0)
    assert got["many"][1] == pytest.approx(7000, rel=3 * quality.SKETCH_ERROR)


def test_profile_reads_once(spark):
    df = spark.createDataFrame([(1, 0.5), (1, None), (3, 2.5), (None, 2.5)], "a long, b double")
    profile = quality.numeric_profile(df, ["a", "b"])
    rows = {r.column_name: tuple(r)[1:] for r in profile.collect()}
    assert rows == {"a": (3, 1.6667, 1.1547, 1.0, 3.0, 2), "b": (3, 1.8333, 1.1547, 0.5, 2.5, 2)}
    plan = quality.numeric_profile(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan ") == 1


def test_date_column_is_found_in_one_job(spark):
    df = spark.createDataFrame([("x", "2024-01-05", "2024-02-01"), (None, None, "y")], "first string, second string, third string")
    tracker, group = spark.sparkContext.statusTracker(), "date-probe"
    spark.sparkContext.setJobGroup(group, group)
    assert periodic.resolve_date(df, ["absent", "first", "second", "third"]) == "second"
    # an aggregate over several partitions is one job per stage with adaptive execution
    assert len(tracker.getJobIdsForGroup(group)) <= 2
    spark.sparkContext._jsc.clearJobGroup()
    with pytest.raises(ValueError, match="no supported date"):
        periodic.resolve_date(df, ["first"])
    with pytest.raises(ValueError, match="found first"):
        periodic.resolve_date(df, ["absent"])
