import datetime as dt

from pyspark.sql import functions as F

from ledgerline.streaming import incremental

SCHEMA = "day date, key string, amount double"


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def lines(batch):
    return batch.filter("amount >= 0").withColumn("month", F.last_day("day"))


def stream(spark, folder):
    return incremental.snapshot_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)


def day(month, number=5):
    return dt.date(2024, month, number)


def test_only_new_files_are_taken(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(spark, source, "one", [(dt.date(2024, 1, 5), "a", 1.0), (dt.date(2024, 1, 6), "a", -1.0)])
    for _ in range(2):
        incremental.ingest(stream(spark, source), target, state, lines)
    assert spark.read.parquet(target).count() == 1
    put(spark, source, "two", [(dt.date(2024, 2, 5), "b", 2.0)])
    incremental.ingest(stream(spark, source), target, state, lines)
    assert sorted(r.key for r in spark.read.parquet(target).collect()) == ["a", "b"]


def maintain(spark, tmp_path):
    """Run what is new, then forget the files: later batches must do without them."""
    source, states, mart, state = (str(tmp_path / n) for n in ("in", "states", "mart", "state"))
    named = incremental.named_snapshots(stream(spark, source))
    incremental.maintain_months(named, states, mart, state, lines, ("key",), {"amount": F.sum("amount"), "rows": F.count("*")})
    for part in (tmp_path / "in").rglob("part-*"):
        part.write_bytes(b"")
    rows = incremental.month_mart(spark, mart).collect()
    return {(r.month.month, r.key): (r.amount, r.rows, r.files) for r in rows}


def folder_names(tmp_path, month):
    return sorted(p.name for p in (tmp_path / "mart" / f"month={month}").iterdir())


def test_a_batch_reads_new_files_and_states_only(spark, tmp_path):
    source = str(tmp_path / "in")
    put(spark, source, "d1/one", [(day(1), "a", 1.0), (day(2), "a", 2.0)])
    assert maintain(spark, tmp_path) == {(1, "a"): (1.0, 1, 1), (2, "a"): (2.0, 1, 1)}
    january = folder_names(tmp_path, "2024-01-31")
    put(spark, source, "d2/two", [(day(2), "b", 5.0), (day(2, 9), "a", 4.0), (day(3), "b", 7.0)])
    got = maintain(spark, tmp_path)
    assert got == {(1, "a"): (1.0, 1, 1), (2, "a"): (6.0, 2, 2), (2, "b"): (5.0, 1, 1), (3, "b"): (7.0, 1, 1)}
    assert maintain(spark, tmp_path) == got
    assert folder_names(tmp_path, "2024-01-31") == january


def test_a_replaced_file_is_taken_back(spark, tmp_path):
    source = str(tmp_path / "in")
    put(spark, source, "d1/one", [(day(1), "a", 1.0), (day(2), "a", 2.0)])
    put(spark, source, "d1/two", [(day(2), "a", 10.0)])
    maintain(spark, tmp_path)
    put(spark, source, "d2/one", [(day(2), "a", 3.0), (day(3), "c", 4.0)])
    assert maintain(spark, tmp_path) == {(2, "a"): (13.0, 2, 2), (3, "c"): (4.0, 1, 1)}
    put(spark, source, "d3/one", [(day(1), "a", -1.0)])  # no clean line is left of it
    assert maintain(spark, tmp_path) == {(2, "a"): (10.0, 1, 1)}
    put(spark, source, "d4/two", [(day(1), "a", 8.0)])
    assert maintain(spark, tmp_path) == {(1, "a"): (8.0, 1, 1)}


def test_files_are_known_by_content(spark, tmp_path):
    source, target, index, state = (str(tmp_path / n) for n in ("in", "out", "index", "state"))

    def run():
        named = incremental.named_snapshots(stream(spark, source))
        incremental.ingest_by_content(named, target, index, state, lines)
        decisions = {(r.batch, r.source_file): r.decision for r in incremental.read_index(spark, index).collect()}
        found = sorted((r.source_file, r.amount) for r in incremental.current_lines(spark, target, index).collect())
        return decisions, found

    a, b, c = [(day(1), "a", 1.0), (day(1), "a", 1.0)], [(day(1), "a", 1.0)], [(day(2), "a", 2.0)]
    put(spark, source, "d1/one", a)
    put(spark, source, "d1/two", b)
    put(spark, source, "d1/zwo", b)
    decisions, found = run()
    assert decisions == {(0, "one"): "new", (0, "two"): "new", (0, "zwo"): "copy"}
    assert found == [("one", 1.0), ("one", 1.0), ("two", 1.0)]
    # the same again; the content of another file; a changed file; the content a changed file had before
    put(spark, source, "d2/one", list(reversed(a)))
    put(spark, source, "d2/three", a)
    put(spark, source, "d2/two", c)
    put(spark, source, "d2/four", b)
    decisions, found = run()
    assert {k[1]: v for k, v in decisions.items() if k[0] == 1} == {"one": "again", "three": "copy", "two": "changed", "four": "new"}
    assert found == [("four", 1.0), ("one", 1.0), ("one", 1.0), ("two", 2.0)]
    assert run() == (decisions, found)
