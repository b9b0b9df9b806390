"""Registered queries: runs, partition-level loads and mart schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers, writers
from .forecasting import CUTOFF, baseline, _baseline, _monthly
from .periods import _sales
from .views import table

MART = "run_id string, order_id bigint, amount double, priority string, note string, loaded_by string"


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as the output of yearly runs."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("run_"), F.year("o_orderdate").cast("string")).alias("run_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


def replace_partition(spark: SparkSession, sf: str) -> DataFrame:
    """A rerun of status P replaces its rows in two runs; the others stay."""
    rows = runs(spark, sf)
    rerun = rows.filter((F.col("status") == "P") & F.col("run_id").isin("run_1997", "run_1998"))
    incoming = rerun.withColumn("amount", F.round(F.col("amount") * 2, 2))
    return writers.replace_keys(rows, incoming, ("run_id", "status"))


def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("dropped"),
    )
    return writers.conform(rows, MART, run_id="r1", loaded_by="batch")


def forecast_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return writers.metadata(
        baseline(spark, sf, "product"), "20001001T000000Z", "rolling_mean_baseline",
        holdout_start=CUTOFF, forecast_horizon_months=3,
    )


QUERIES = {
    "latest_run": lambda s, d: readers.latest_run(runs(s, d)),
    "replace_partition": replace_partition,
    "conform_schema": conform_schema,
    "forecast_metadata": forecast_metadata,
}

_RUNS = """runs AS (SELECT 'run_' || year(o_orderdate) AS run_id, o_orderkey AS order_id, o_totalprice AS amount,
  o_orderstatus AS status FROM orders)"""

ORACLES = {
    "latest_run": f"WITH {_RUNS} SELECT * FROM runs WHERE run_id = (SELECT max(run_id) FROM runs)",
    "replace_partition": f"""WITH {_RUNS} SELECT run_id, order_id, status,
        CASE WHEN status = 'P' AND run_id IN ('run_1997', 'run_1998') THEN round(amount * 2, 2) ELSE amount END AS amount FROM runs""",
    "conform_schema": """SELECT 'r1' AS run_id, o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
        o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS note, 'batch' AS loaded_by FROM orders""",
    "forecast_metadata": _sales(
        f""", {_monthly('product')}, {_baseline('product')} SELECT '20001001T000000Z' AS generated_at, 'rolling_mean_baseline' AS method,
        '{CUTOFF}' AS holdout_start, '3' AS forecast_horizon_months, count(*) AS record_count FROM baseline"""
    ),
}
