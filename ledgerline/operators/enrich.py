"""Lookups and derived measures on sales lines.

Lookup joins carry no broadcast hint: Spark measures the lookup and broadcasts
it below its size threshold, and falls back to a shuffle join with skew handling
above it.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import rules
from ..functions.numbers import exchange_rate


def convert_currency(
    df: DataFrame,
    currency: str = "Currency",
    price: str = "Price",
    total: str = "Total",
    rates: Mapping[str, str] = fixed.EXCHANGE_RATES,
) -> DataFrame:
    """US dollar price and total; amounts count to six decimals."""
    priced = df.withColumn("exchange_rate_to_usd", exchange_rate(F.col(currency), rates))
    rate = F.col("exchange_rate_to_usd")
    return priced.withColumns(
        {
            "usd_adjusted_price": F.col(price).cast("decimal(20,6)") * rate,
            "usd_adjusted_total": F.col(total).cast("decimal(20,6)") * rate,
        }
    )


def require_columns(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks: {', '.join(missing)}")
    return df.select(*columns)


def map_region(
    df: DataFrame, lookup: DataFrame, country: str = "Country", region: str = "Region"
) -> DataFrame:
    """Region by country. A region already on the line is kept."""
    pairs = require_columns(lookup, ["Country", "Region"], "country lookup").toDF(country, "_region")
    joined = df.join(pairs, country, "left")
    own = F.col(region) if region in df.columns else F.lit(None).cast("string")
    return joined.withColumn(region, F.coalesce(own, "_region")).drop("_region")


def attach_bays(
    df: DataFrame, lookup: DataFrame, product: str = "Product", quantity: str = "Quantity"
) -> DataFrame:
    pairs = require_columns(lookup, ["Product", "Bays"], "device lookup").toDF(product, "Bays")
    return df.join(pairs, product, "left").withColumn("total_bays", F.col("Bays") * F.col(quantity))


def drive_capacity(df: DataFrame, product: str = "Product", category: str = "Type") -> DataFrame:
    """Capacity of the drives among the products."""
    return df.withColumn("Capacity", rules.drive_capacity(F.col(product), F.col(category)))


def total_capacity(df: DataFrame, category: str = "Type", quantity: str = "Quantity") -> DataFrame:
    """Unit and total capacity of lines whose capacity is known."""
    units = F.when(F.col(category) == fixed.CAPACITY_CATEGORY, F.coalesce(quantity, F.lit(0)))
    return df.withColumns(
        {
            "Unit": F.when(F.col("Capacity").isNotNull(), fixed.CAPACITY_UNIT),
            "total_cap": F.coalesce(units, F.lit(0)) * F.coalesce("Capacity", F.lit(0)),
        }
    )
