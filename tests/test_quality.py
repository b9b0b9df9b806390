import pytest

from ledgerline.operators import quality


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", 1.0), (1, "a", None), (2, None, 3.0), (2, "z", 100.0)], "id int, c string, v double")


def test_rules(spark, df):
    checks = quality.not_null(df, ["id", "c", "v"])
    assert {r.rule: r.failures for r in checks.collect()} == {"not_null_id": 0, "not_null_c": 1, "not_null_v": 1}
    with pytest.raises(quality.QualityError, match="not_null_c: 1"):
        quality.require(checks)
    quality.require(quality.not_null(df, ["id"]))
    assert {(r.id, r.copies) for r in quality.repeated_keys(df, ["id"]).collect()} == {(1, 2), (2, 2)}
    assert {(r.value, r.rows) for r in quality.unaccepted(df, "c", ["a"]).collect()} == {(None, 1), ("z", 1)}
    parent = spark.createDataFrame([("a",)], "key string")
    assert [r.c for r in quality.orphans(df, "c", parent, "key").collect()] == ["z"]


def test_reconcile_and_duplicates(df):
    row = quality.reconcile(df.na.fill(0.0), "c", "v").collect()[0]
    assert (row.slices, row.total, row.total_rows, row.matches) == (3, 104.0, 4, True)
    dup = quality.duplicates(df, ["id"]).collect()[0]
    assert (dup.rows, dup.duplicate_rows, dup.duplicate_ratio) == (4, 2, 0.5)


def test_manifest_ignores_row_order(df):
    one = {tuple(r) for r in quality.manifest(df, "id").collect()}
    two = {tuple(r) for r in quality.manifest(df.orderBy("v").repartition(3), "id").collect()}
    assert one == two and len(one) == 2


def test_features(spark):
    import datetime as dt

    f = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, 2.0), (dt.date(2024, 6, 1), 1.0, None)], "d date, x double, y double")
    got = {r.feature: (r.missing, r.constant, r.late_rows) for r in quality.feature_checks(f, ["x", "y"], "d", "2024-05-01").collect()}
    assert got == {"x": (0, True, 1), "y": (1, True, 1)}


def test_profiles(df):
    shares = {r.column_name: r.missing_percent for r in quality.null_profile(df).collect()}
    assert shares == {"id": 0.0, "c": 25.0, "v": 25.0}
    assert quality.drop_sparse(df, 20.0).columns == ["id"]
    box = quality.box_stats(df, "v", ["id"]).collect()
    assert {(r.id, r.median, r.outliers) for r in box} == {(1, 1.0, 0), (2, 51.5, 0)}
    assert quality.numeric_columns(df) == ["id", "v"]


def test_null_injection_repeats(spark):
    rows = spark.range(4000).withColumnRenamed("id", "k").selectExpr("k", "1.0 as v")
    first = {r.k for r in quality.inject_nulls(rows, "v", ["k"], 0.05).filter("v is null").collect()}
    again = {r.k for r in quality.inject_nulls(rows.repartition(7), "v", ["k"], 0.05).filter("v is null").collect()}
    assert first == again and 130 < len(first) < 270
