"""Cleaning of raw sales lines.

Steps are DataFrame to DataFrame and skip columns a frame does not have. The
whole chain is one lazy plan, the same at every size; only the mode fills need an
aggregate, and those aggregate counts per value first, so a value that fills a
third of the table costs one row per map task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..functions import rules, text
from ..functions.numbers import to_number
from ..functions.periods import any_date
from ..session import settle
from . import enrich


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def normalise_missing(
    df: DataFrame,
    trim: Sequence[str] = fixed.TRIM_COLUMNS,
    strict: bool = False,
    skip: Sequence[str] = (),
) -> DataFrame:
    """Null tokens to null in every text column, then trim the named ones."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType) and field.name not in skip:
            cell = text.null_tokens_to_null(F.col(field.name), strict)
            changed[field.name] = text.strip(cell) if field.name in trim else cell
    return df.withColumns(changed) if changed else df


def coerce_numbers(df: DataFrame, columns: Sequence[str] = fixed.NUMERIC_COLUMNS) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in present(df, columns)})


def drop_negative(df: DataFrame, columns: Sequence[str] = ("Quantity", "Total")) -> DataFrame:
    """Drop rows with a negative value; missing values stay."""
    tests = [F.coalesce(F.col(c), F.lit(0.0)) >= 0 for c in present(df, columns)]
    return df.filter(reduce(and_, tests)) if tests else df


def require_values(df: DataFrame, columns: Sequence[str] = fixed.CRITICAL_COLUMNS) -> DataFrame:
    tests = [F.col(c).isNotNull() for c in present(df, columns)]
    return df.filter(reduce(and_, tests)) if tests else df


def fill_quantity(df: DataFrame, column: str = "Quantity") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, F.greatest(F.coalesce(F.col(column), F.lit(0.0)), F.lit(0.0)))


def drop_low_value(df: DataFrame, columns: Sequence[str] = fixed.LOW_VALUE_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of values, as ``n``."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def _most_frequent(column: str) -> Column:
    """Value with the highest ``n``; the smallest value wins a tie."""
    return F.min_by(F.col(column), F.struct(-F.col("n"), F.col(column)))


def fill_mode(df: DataFrame, column: str, counts: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the most frequent value of the column.

    ``counts`` may be any value counts that include the column, so several fills
    can share one pass over the lines.
    """
    if column not in df.columns:
        return df
    known = (value_counts(df, column) if counts is None else counts).filter(F.col(column).isNotNull())
    mode = known.groupBy(column).agg(F.sum("n").alias("n")).agg(_most_frequent(column).alias(column))
    return df.withColumn(column, F.coalesce(F.col(column), mode.scalar()))


def fill_group_mode(
    df: DataFrame, group: str, column: str, counts: DataFrame | None = None
) -> DataFrame:
    """Fill nulls with the most frequent value within ``group``.

    ``counts`` should be settled: with its true size known, Spark broadcasts the
    modes when they are small and the lines are not shuffled by ``group``.
    """
    if group not in df.columns or column not in df.columns:
        return df
    counts = settle(value_counts(df, group, column)) if counts is None else counts
    known = counts.filter(F.col(column).isNotNull() & F.col(group).isNotNull())
    totals = known.groupBy(group, column).agg(F.sum("n").alias("n"))
    modes = totals.groupBy(group).agg(_most_frequent(column).alias("_mode"))
    filled = df.join(modes, group, "left")
    return filled.withColumn(column, F.coalesce(column, "_mode")).select(*df.columns)


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls with the column mean, in double."""
    mean = df.agg(F.avg(column).cast("double").alias(column))
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), mean.scalar()))


def parse_dates(df: DataFrame, columns: Sequence[str] = ("InvDate", "ShipDate")) -> DataFrame:
    return df.withColumns({c: any_date(F.col(c)) for c in present(df, columns)})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Unknown destination, and the product name as item code of last resort."""
    changed = {}
    if "ShipTo" in df.columns:
        changed["ShipTo"] = F.coalesce(F.col("ShipTo"), F.lit(fixed.UNKNOWN_DESTINATION))
    if "ItemCode" in df.columns and "Product" in df.columns:
        changed["ItemCode"] = F.coalesce(
            F.col("ItemCode"), F.col("Product"), F.lit(fixed.UNSPECIFIED_SKU)
        )
    return df.withColumns(changed) if changed else df


def classify(
    df: DataFrame, product: str = "Product", type_column: str = "Type", sub: str = "sub_cat"
) -> DataFrame:
    """Category and sub-category. Each step is a projection of its own on purpose."""
    named = df.withColumn("_name", rules.normalised(F.col(product)))
    typed = named.withColumn(type_column, rules.category("_name"))
    return typed.withColumn(sub, rules.subcategory("_name", f"`{type_column}`")).drop("_name")


def synthetic_order_key(df: DataFrame, keys: Sequence[str], order: str = "PI") -> DataFrame:
    """An order key built from existing key columns where the frame has none.

    A positional id would change between runs; this does not.
    """
    if order in df.columns:
        return df
    return df.withColumn(order, F.concat_ws("_", F.lit("order"), *[F.col(k) for k in keys]))


def default_region(df: DataFrame, column: str = "Region") -> DataFrame:
    region = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.coalesce(region, F.lit("Unknown")))


def clean_sales(
    raw: DataFrame,
    rates: Mapping[str, str] = fixed.EXCHANGE_RATES,
    country_regions: DataFrame | None = None,
    device_bays: DataFrame | None = None,
    strict_nulls: bool = False,
) -> DataFrame:
    """The complete cleaning sequence, from raw text columns to typed sales lines.

    The lines are read twice. The first pass counts the combinations of currency,
    country and region, which the dimensions bound; the three mode fills work on
    those counts. The second pass cleans the lines. Category, sub-category and
    capacity are functions of the product name and are worked out on the line.
    """
    df = normalise_missing(trim_headers(raw), strict=strict_nulls, skip=fixed.NUMERIC_COLUMNS)
    df = fill_quantity(require_values(drop_negative(coerce_numbers(df))))
    df = df.withColumn("Product", text.drop_leading_parenthesis(F.col("Product")))
    places = present(df, ("Currency", "Country", "Region"))
    counts = settle(value_counts(df, *places))
    df = fill_mode(df, "Currency", counts)
    df = enrich.convert_currency(enrich.drive_capacity(classify(df)), rates=rates)
    df = drop_low_value(fill_defaults(parse_dates(df)))
    df = df.withColumn("Year", F.year("InvDate"))
    if country_regions is not None:
        df = enrich.map_region(df, country_regions)
        counts = enrich.map_region(counts, country_regions)
    df = fill_group_mode(df, "Country", "Region", counts)
    df = fill_mode(df, "Region", fill_group_mode(counts, "Country", "Region", counts))
    df = enrich.total_capacity(df)
    return enrich.attach_bays(df, device_bays) if device_bays is not None else df
