"""Registered queries: incremental ingestion and the incremental monthly mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from ..streaming import incremental
from .views import table


def orders_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The order files as a stream. The pattern fits one file and a folder of files."""
    schema = table(spark, sf, "orders").schema
    return incremental.snapshot_stream(spark, f"{sf}/orders.parquet*", schema)


def clean(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col("o_totalprice") > 0).select(
        *[c for c in ("source_file",) if c in batch.columns],
        F.col("o_orderkey").alias("order_id"),
        F.last_day(F.col("o_orderdate").cast("date")).alias("month"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Stream the order files through cleaning into a table, and read the table."""
    target, state = incremental.fresh_folder(work_dir(spark), ("lines", "state"))
    incremental.ingest(orders_stream(spark, sf), target, state, clean)
    stored = spark.read.parquet(target)
    return stored.select("order_id", "month", "priority", F.col("amount").cast("double").alias("amount"))


def maintain(stream: DataFrame, folder: str) -> None:
    """Orders and amounts by month and priority, from the stream of order files."""
    measures = {"orders": F.count("*"), "amount": F.sum("amount")}
    incremental.maintain_months(
        incremental.named_snapshots(stream), f"{folder}/states", f"{folder}/mart", f"{folder}/checkpoint", clean, ("priority",), measures
    )


def month_rows(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.month_mart(spark, f"{folder}/mart").select("month", "priority", "orders", F.col("amount").cast("double").alias("amount"))


def incremental_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly mart as the stream of order files builds it."""
    (folder,) = incremental.fresh_folder(work_dir(spark), ("monthly",))
    maintain(orders_stream(spark, sf), folder)
    return month_rows(spark, folder)


def deliver(orders: DataFrame, folder: str) -> None:
    """One file per value of the column ``file``."""
    orders.repartition("file").write.partitionBy("file").parquet(folder)


def _deliveries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of yearly files: the second has a file again, a copy under another name, and a changed one."""
    orders = table(spark, sf, "orders")
    year = F.year("o_orderdate").cast("string")
    first = orders.withColumn("file", F.concat(F.lit("orders_"), year))
    again = first.filter(year == "1996")
    copied = first.filter(year == "1997").withColumn("file", F.lit("copy_of_1997"))
    changed = first.filter((year == "1998") & (F.col("o_orderkey") % 2 == 0)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return first, again.unionByName(copied).unionByName(changed)


def redelivered_files(spark: SparkSession, sf: str) -> DataFrame:
    """The lines that count after both deliveries, by the content of their files."""
    inbox, target, index, state = incremental.fresh_folder(work_dir(spark), ("inbox", "lines", "index", "state"))
    for number, delivery in enumerate(_deliveries(spark, sf)):
        deliver(delivery, f"{inbox}/{number}")
        stream = incremental.named_snapshots(incremental.snapshot_stream(spark, inbox, table(spark, sf, "orders").schema))
        incremental.ingest_by_content(stream, target, index, state, clean)
    lines = incremental.current_lines(spark, target, index)
    return lines.select("source_file", "order_id", "month", "priority", F.col("amount").cast("double").alias("amount"))


def replaced_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly mart after both deliveries: what a file held before is taken back. The copy counts, it has a name of its own."""
    inbox, folder = incremental.fresh_folder(work_dir(spark), ("inbox", "monthly"))
    for number, delivery in enumerate(_deliveries(spark, sf)):
        deliver(delivery, f"{inbox}/{number}")
        maintain(incremental.snapshot_stream(spark, inbox, table(spark, sf, "orders").schema), folder)
    return month_rows(spark, folder)


QUERIES = {
    "incremental_ingest": incremental_ingest,
    "incremental_monthly": incremental_monthly,
    "redelivered_files": redelivered_files,
    "replaced_monthly": replaced_monthly,
}

_AFTER = """WITH named AS (SELECT *, 'orders_' || year(o_orderdate) AS file FROM orders),
  after AS (SELECT * FROM named WHERE file <> 'orders_1998'
    UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM named WHERE file = 'orders_1998' AND o_orderkey % 2 = 0)"""

ORACLES = {
    "redelivered_files": f"""{_AFTER} SELECT file AS source_file, o_orderkey AS order_id, last_day(CAST(o_orderdate AS DATE)) AS month,
        o_orderpriority AS priority, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM after WHERE o_totalprice > 0""",
    "replaced_monthly": f"""{_AFTER}, counted AS (SELECT * FROM after UNION ALL SELECT * FROM after WHERE file = 'orders_1997')
        SELECT last_day(CAST(o_orderdate AS DATE)) AS month, o_orderpriority AS priority, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount FROM counted WHERE o_totalprice > 0 GROUP BY ALL""",
    "incremental_ingest": """SELECT o_orderkey AS order_id, last_day(CAST(o_orderdate AS DATE)) AS month, o_orderpriority AS priority,
        CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM orders WHERE o_totalprice > 0""",
    "incremental_monthly": """SELECT last_day(CAST(o_orderdate AS DATE)) AS month, o_orderpriority AS priority, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount FROM orders WHERE o_totalprice > 0 GROUP BY ALL""",
}
