"""Month and quarter aggregates, zero-filled spines and period splits."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..functions.periods import any_date, month_end, quarter_end, quarter_start, quarter_starts
from ..session import settle


def resolve_date(df: DataFrame, candidates: Sequence[str] = fixed.DATE_CANDIDATES) -> str:
    """First candidate column that holds any date. One aggregate probes all candidates."""
    present = [name for name in candidates if name in df.columns]
    if present:
        held = df.agg(*[F.bool_or(any_date(F.col(f"`{name}`")).isNotNull()).alias(f"_{i}") for i, name in enumerate(present)]).first()
        for name, holds in zip(present, held):
            if holds:
                return name
    raise ValueError(
        f"no supported date column; expected one of {', '.join(candidates)}, found {', '.join(df.columns)}"
    )


def _need(df: DataFrame, column: str, what: str) -> None:
    if column not in df.columns:
        raise ValueError(f"{what} column '{column}' is not in the table")


def fill_quarter_gaps(
    totals: DataFrame, segments: Sequence[str], value: str = "quarter_total",
    levels: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Zero rows for every missing quarter of every observed combination of segments.

    The range of quarters is that of the whole table. ``levels`` lists the levels of
    each segment where all their combinations are wanted, observed or not. Zero rows are
    appended and summed with the observed ones, which treats null keys like any other.
    """
    bounds = totals.agg(
        F.struct(F.min("sale_quarter").alias("lo"), F.max("sale_quarter").alias("hi")).alias("b")
    )
    if levels is not None:
        grid = bounds
        for c in segments:
            kind = totals.schema[c].dataType
            grid = grid.withColumn(c, F.explode(F.array(*[F.lit(x).cast(kind) for x in levels[c]])))
        quarters = quarter_starts(F.col("b.lo"), F.col("b.hi"))
    elif segments:
        grid, span = totals.select(*segments).distinct(), bounds.scalar()
        quarters = quarter_starts(span["lo"], span["hi"])
    else:
        grid, quarters = bounds, quarter_starts(F.col("b.lo"), F.col("b.hi"))
    kind = totals.schema[value].dataType
    zeros = grid.select(
        *segments, F.explode(quarters).alias("sale_quarter"), F.lit(0).cast(kind).alias(value)
    )
    both = totals.select(*segments, "sale_quarter", value).unionByName(zeros)
    return both.groupBy(*segments, "sale_quarter").agg(F.sum(value).alias(value))


def quarterly_totals(
    df: DataFrame,
    value: str,
    segments: Sequence[str] = (),
    date: str | None = None,
    fill_gaps: bool = True,
    levels: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Total per observed segment and quarter, contiguous over quarters; ``levels`` asks for a full grid."""
    _need(df, value, "value")
    for c in segments:
        _need(df, c, "segment")
    day = any_date(F.col(date or resolve_date(df)))

    def level(c: str) -> Column:
        text = isinstance(df.schema[c].dataType, T.StringType)
        return (F.coalesce(F.col(c), F.lit("Unknown")) if text else F.col(c)).alias(c)

    amount = F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType))
    rows = df.filter(day.isNotNull()).select(
        *[level(c) for c in segments], quarter_start(day).alias("sale_quarter"), amount.alias("v")
    )
    totals = rows.groupBy(*segments, "sale_quarter").agg(F.sum("v").alias("quarter_total"))
    if fill_gaps:
        totals = fill_quarter_gaps(settle(totals), segments, levels=levels)
    return totals.select(
        *segments,
        "sale_quarter",
        F.col("quarter_total").cast("double").alias("quarter_total"),
        quarter_start(F.col("sale_quarter")).alias("quarter_start"),
        quarter_end(F.col("sale_quarter")).alias("quarter_end"),
    )


def tag_focus(
    df: DataFrame, column: str, products: Sequence[str], flag: str = "is_focus_product"
) -> DataFrame:
    """Boolean flag for the products in focus."""
    _need(df, column, "product")
    if not products:
        raise ValueError("the focus list is empty")
    return df.withColumn(flag, F.coalesce(F.col(column).isin(*products), F.lit(False)))


def quarterly_views(
    df: DataFrame, value: str, column: str, products: Sequence[str], segments: Sequence[str] = (), date: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Quarterly totals of everything and of the focus products."""
    flag = "is_focus_product"
    tagged = tag_focus(df, column, products, flag)
    keys = [*segments, flag] if flag not in segments else list(segments)
    date = date or resolve_date(df)
    return (
        quarterly_totals(tagged, value, keys, date),
        quarterly_totals(tagged.filter(flag), value, keys, date),
    )


def split_latest(quarterly: DataFrame, column: str = "sale_quarter") -> tuple[DataFrame, DataFrame, Column]:
    """History, the latest period, and that period as a column."""
    _need(quarterly, column, "quarter")
    latest = quarterly.agg(F.max(column).alias(column)).scalar()
    period = F.col(column)
    return quarterly.filter(period < latest), quarterly.filter(period == latest), latest


def require_split(train: DataFrame, test: DataFrame) -> None:
    if train.isEmpty() or test.isEmpty():
        raise ValueError("not enough quarters for a train and a test part")


def label_holdout(df: DataFrame, date: str, start: str) -> DataFrame:
    """Both parts in one table, told apart by ``part``."""
    past = F.col(date) < F.lit(start).cast("date")
    return df.withColumn("part", F.when(past, "history").otherwise("holdout"))


def holdout_split(df: DataFrame, date: str, start: str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``start`` and rows from it on."""
    cut = F.lit(start).cast("date")
    return df.filter(F.col(date) < cut), df.filter(F.col(date) >= cut)


def monthly_history(history: DataFrame, keys: Sequence[str] = ("sku", "channel")) -> DataFrame:
    """Quantity and revenue per key and month end."""
    return history.groupBy(*keys, month_end(F.col("sale_date")).alias("sale_month")).agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")
    )


def fill_month_gaps(
    monthly: DataFrame, measures: Sequence[str], keys: Sequence[str] = (), month: str = "sale_month"
) -> DataFrame:
    """A row for every month between the first and last of a key, zero where none was.

    Each observed row is stretched up to the next one, so no spine and no join is
    needed. Input is one row per key and month; without keys that is one row per
    month, which is what the window without a partition runs over.
    """
    order = (Window.partitionBy(*keys) if keys else Window).orderBy(month)
    here = F.trunc(F.col(month), "month")
    last = F.coalesce(F.add_months(F.trunc(F.col("_next"), "month"), -1), here)
    step = F.expr("interval 1 month")
    stretched = monthly.withColumn("_next", F.lead(month).over(order)).withColumn(
        "_month", F.explode(F.sequence(here, last, step))
    )
    own = F.col("_month") == here
    return stretched.select(
        *keys,
        F.last_day("_month").alias(month),
        *[
            F.when(own, F.col(m)).otherwise(F.lit(0).cast(monthly.schema[m].dataType)).alias(m)
            for m in measures
        ],
    )


def monthly_series(history: DataFrame) -> DataFrame:
    """One contiguous monthly series over all lines."""
    monthly = history.groupBy(month_end(F.col("sale_date")).alias("sale_month")).agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")
    )
    return fill_month_gaps(monthly, ("quantity", "revenue"))


def monthly_actuals(lines: DataFrame, attributes: dict[str, str]) -> DataFrame:
    """Actuals per sku and month with product attributes.

    An attribute is the smallest value of the group: the first one in row order
    would change from run to run.
    """
    return lines.groupBy(month_end(F.col("inv_date")).alias("sale_month"), "sku").agg(
        F.sum("quantity").alias("actual_quantity"),
        F.sum("usd_total").alias("actual_revenue"),
        *[F.min(source).alias(name) for name, source in attributes.items()],
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns asked for, or an error that lists the missing ones."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df.select(*columns)


