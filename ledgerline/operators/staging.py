"""Staging projection: shape-checked casts from text to the fixed staging schema."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text
from ..functions.numbers import plain_decimal
from ..functions.periods import iso_date


def stage_sales(raw: DataFrame, sheets: Sequence[str] | None = None) -> DataFrame:
    """Typed sales lines of the given sheets, one scan for all of them.

    Lines without a usable date or sku are left out; a quantity or revenue that is
    not a plain number stays null.
    """
    if sheets is not None:
        raw = raw.filter(F.col("source_sheet").isin(*sheets))
    item, product = text.null_if_blank(F.col("ItemCode")), text.null_if_blank(F.col("Product"))
    return raw.select(
        iso_date(F.col("InvDate")).alias("sale_date"),
        item.alias("item_code"),
        product.alias("product_name"),
        F.coalesce(item, product).alias("sku"),
        F.col("source_sheet").alias("channel"),
        plain_decimal(F.col("Quantity")).alias("quantity"),
        plain_decimal(F.col("Total")).alias("revenue"),
    ).filter(F.col("sale_date").isNotNull() & F.col("sku").isNotNull())


def empty_staging(spark: SparkSession) -> DataFrame:
    """The staging relation when there are no sources."""
    return spark.createDataFrame([], fixed.STAGING)


def split_suites(lines: DataFrame, suites: dict[str, Sequence[str]], sheet: str = "source_sheet") -> DataFrame:
    """Suite of every line, for one partitioned write instead of one scan per suite."""
    chain = F
    for suite, members in suites.items():
        chain = chain.when(F.col(sheet).isin(*members), suite)
    return lines.withColumn("suite", chain.otherwise(None)).filter(F.col("suite").isNotNull())
