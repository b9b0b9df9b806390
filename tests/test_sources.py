import pytest

from ledgerline.sources import readers, writers


def test_split_and_reread_with_name_collision(spark, tmp_path):
    one = spark.createDataFrame([("2024/01", 5)], "Month string, Quantity long")
    two = spark.createDataFrame([("2024/02", 7)], "Month string, Quantity long")
    paths = writers.write_sheets({"North Shop": one, "North-Shop": two}, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths.values()] == ["north_shop", "north_shop_2"]
    back = spark.read.option("header", True).csv(paths["North-Shop"]).collect()
    assert [(r.Month, r.Quantity) for r in back] == [("2024/02", "7")]
    with pytest.raises(ValueError, match="xlsx"):
        writers.write_sheets({"a": one}, str(tmp_path), kind="xlsx")


def test_tokens_stay_unique_when_a_number_is_taken(spark):
    assert list(writers.unique_tokens(spark, ["a", "a_2", "a!", "!!"]).values()) == ["a", "a_2", "a_3", "worksheet"]


def test_read_sheets_with_different_headers(spark, tmp_path):
    (tmp_path / "2023.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2024.csv").write_text("b,c\n3,4\n")
    rows = {tuple(r) for r in readers.read_sheets(spark, str(tmp_path)).select("a", "b", "c", "source_sheet").collect()}
    assert rows == {("1", "2", None, "2023"), (None, "3", "4", "2024")}
    only = readers.read_sheets(spark, str(tmp_path), ["2024"])
    assert only.columns == ["b", "c", "source_sheet"]
    with pytest.raises(ValueError, match="2025"):
        readers.read_sheets(spark, str(tmp_path), ["2024", "2025"])


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_a_thousand_files_of_two_headers_are_two_scans(spark, tmp_path):
    for i in range(1000):
        header, row = (("a,b", f"{i},x") if i % 3 else ("b,c", f"y,{i}"))
        (tmp_path / f"shop {i}%.csv").write_text(f"{header}\n{row}\n")
    df = readers.read_sheets(spark, str(tmp_path))
    assert scans(df) == 2
    rows = {r.source_sheet: (r.a, r.b, r.c) for r in df.collect()}
    assert rows == {f"shop {i}%": (str(i), "x", None) if i % 3 else (None, "y", str(i)) for i in range(1000)}


def test_folders_of_part_files_and_files_without_rows(spark, tmp_path):
    df = spark.createDataFrame([(i, f"s+{i % 2}") for i in range(40)], "n long, sheet string").repartition(3)
    df.write.partitionBy("sheet").option("header", True).csv(str(tmp_path / "parts"))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bare.csv").write_text("n\n")
    (tmp_path / "marked.csv").write_bytes(b"\xef\xbb\xbfn\r\n7\r\n")
    rows = readers.read_sheets(spark, str(tmp_path)).collect()
    assert sorted((int(r.n), r.source_sheet) for r in rows) == sorted([(i, f"s+{i % 2}") for i in range(40)] + [(7, "marked")])
    with pytest.raises(ValueError, match="not found: empty"):  # a file without a line is no sheet
        readers.read_sheets(spark, str(tmp_path), ["empty"])


def test_first_lines_where_tasks_hold_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "_ONE_FILE", 1 << 20)
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text(f"h{i}\n" + "line\n" * i)
    spark.newSession()
    found = readers.layouts(spark, str(tmp_path))
    assert len(found) == 30 and all(len(paths) == 1 for paths in found)


def test_history_falls_back_to_csv(spark, tmp_path):
    (tmp_path / "im_sales_history_1.csv").write_text("Month,SKU,Qty\n2024/01,x,-3\nbad,x,1\n")
    (tmp_path / "sales_history_2.csv").write_text("Date,Product,Quantity,Revenue\n2024-02-03,y,2,9.5\n")
    (tmp_path / "broken.csv").write_text("Date,Quantity\n2024-02-03,2\n")
    rows = {
        (str(r.sale_date), r.sku, r.channel, r.quantity, r.revenue)
        for r in readers.load_history(spark, str(tmp_path / "absent"), str(tmp_path)).collect()
    }
    assert rows == {("2024-01-01", "x", "IM", 0.0, 0.0), ("2024-02-03", "y", "TDBS", 2.0, 9.5)}


def test_history_prefers_parquet_and_keeps_negative(spark, tmp_path):
    clean = spark.createDataFrame(
        [("2024-01-05", None, " p ", "s", "-1", "2.5"), ("bad", "i", "p", "s", "1", "1")],
        "InvDate string, ItemCode string, Product string, source_sheet string, Quantity string, usd_adjusted_total string",
    )
    path = str(tmp_path / "clean")
    clean.write.parquet(path)
    rows = readers.load_history(spark, path, str(tmp_path)).collect()
    assert [(r.sku, r.channel, r.quantity, r.revenue) for r in rows] == [("p", "s", -1.0, 2.5)]
    with pytest.raises(ValueError, match="date"):
        readers.history_from_clean(clean.drop("InvDate"))
    with pytest.raises(ValueError, match="sku"):
        readers.history_from_clean(clean.drop("ItemCode", "Product"))


def test_lookup_columns(spark, tmp_path):
    (tmp_path / "l.csv").write_text("Country,Area\nx,y\n")
    with pytest.raises(ValueError, match="Region"):
        readers.read_lookup(spark, str(tmp_path / "l.csv"), ["Country", "Region"])


def test_latest_run_prefers_its_combined_table(spark):
    plain = spark.createDataFrame([("r1", 1), ("r2", 2)], "run_id string, v int")
    combined = spark.createDataFrame([("r1", 10, 0)], "run_id string, v int, actual int")
    assert [r.v for r in readers.latest_run(plain).collect()] == [2]
    assert [r.v for r in readers.prefer_combined(combined, plain).collect()] == [2]
    newer = spark.createDataFrame([("r2", 20, 5), ("r2", 21, 6)], "run_id string, v int, actual int")
    assert sorted(r.v for r in readers.prefer_combined(newer, plain).collect()) == [20, 21]


def test_partition_load_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "mart")
    first = spark.createDataFrame([("a", "m", 1), ("b", "m", 2)], "cohort string, model string, v int")
    again = spark.createDataFrame([("a", "m", 7)], "cohort string, model string, v int")
    writers.load_partitions(first, path, ["cohort", "model"])
    for _ in range(2):
        writers.load_partitions(again, path, ["cohort", "model"])
    assert sorted((r.cohort, r.v) for r in spark.read.parquet(path).collect()) == [("a", 7), ("b", 2)]


def test_refresh_keeps_old_rows_when_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    full = spark.createDataFrame([(1,)], "v int")
    assert writers.refresh(full, path)
    assert not writers.refresh(full.limit(0), path)
    assert spark.read.parquet(path).count() == 1


def test_projection_suites_exports_and_views(spark, tmp_path):
    df = spark.createDataFrame([("A", "2023", 1.0), ("B", "2024", 2.0)], "Customer string, source_sheet string, extra double")
    assert writers.write_projected(df, str(tmp_path / "p")) == ["Customer", "source_sheet"]
    writers.write_by_sheet(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2
    done = writers.export_marts({"m": (df, ["Customer"]), "gone": (None, [])}, str(tmp_path / "x"))
    assert done == ["m"]
    writers.materialise(df.withColumnRenamed("source_sheet", "channel"), "staged_lines", {"suite_x": ["2023"]})
    assert [r.Customer for r in spark.table("suite_x").collect()] == ["A"]
    assert [r.Customer for r in readers.read_mart(spark, "staged_lines", ["Customer"]).collect()] == ["A", "B"]


def test_forecast_rows_for_the_mart(spark, tmp_path):
    df = spark.createDataFrame([("2024-11-30", "-2", "5.5"), (None, "1", "1")], "sale_month string, forecast_quantity string, forecast_revenue string")
    row = writers.prepare_forecast(df, "focus", "r1", "baseline", "v1").collect()
    assert len(row) == 1
    assert (row[0].sku, row[0].channel, row[0].forecast_quantity, row[0].actual_revenue) == ("FOCUS_ALL", "focus", 0.0, None)
    assert str(row[0].sale_month) == "2024-11-30" and row[0].created_at is not None
    writers.write_forecast(df, str(tmp_path), "r1", "baseline", "rolling_mean", horizon=3)
    meta = spark.read.json(str(tmp_path / "baseline_meta_r1")).collect()[0]
    assert (meta.record_count, meta.horizon) == (2, "3")
