"""Reading sheets, histories, lookups and forecast runs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text
from ..functions.periods import any_date, date_like
from ..functions.numbers import clip_negative, number_or_zero

# --- sheets ------------------------------------------------------------------------


def pick_sheets(available: Sequence[str], requested: Sequence[str] | None) -> list[str]:
    """Sheets to read, in the order asked for. Unknown names are an error."""
    if not requested:
        return list(available)
    missing = sorted(set(requested) - set(available))
    if missing:
        raise ValueError(f"sheets not found: {', '.join(missing)}")
    return list(requested)


def union_sheets(sheets: Mapping[str, DataFrame], include: Sequence[str] | None = None) -> DataFrame:
    """All sheets under each other by column name, with the sheet they came from."""
    names = pick_sheets(list(sheets), include)
    if not names:
        raise ValueError("no sheets to read")
    named = [sheets[n].withColumn("source_sheet", F.lit(n)) for n in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


#: More bytes than any split holds: with this as size and as opening cost, every file is one task of its own.
_ONE_FILE = 1 << 50


def sheet_name(path: Column) -> Column:
    """The sheet a file belongs to: its name without ending; of a part file, its folder's name or partition value."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    parts = F.split(plain, "/")
    name = F.element_at(parts, -1)
    folder = F.regexp_replace(F.element_at(parts, -2), "^[^=]*=", "")
    return F.when(name.rlike("^part-[0-9]{5}-"), folder).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))


def sheet_files(spark: SparkSession, directory: str, glob: str = "*.csv") -> DataFrame:
    """path, its encoded form (key), sheet, bytes of every file below a folder. Lists through Spark and reads no contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(directory)
    key = F.col("_metadata.file_path")
    return files.select("path", key.alias("key"), sheet_name(key).alias("sheet"), F.col("length").alias("bytes"))


def first_lines(spark: SparkSession, files: Mapping[str, str]) -> dict[str, str]:
    """Key to first line, for files (key to path) with a line, in one job.

    A task opens a file, takes a line and stops. Should a session deal several files to a task, the files
    behind the first are read in a second job, line by line.
    """

    def heads(stop: bool):
        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last = None
            for batch in batches:
                keys, starts = batch.column("key").to_pylist(), batch.column("start").to_pylist()
                fresh = [i for i, key in enumerate(keys) if starts[i] == 0 and key != (keys[i - 1] if i else last)]
                yield batch.take(pa.array(fresh, pa.int64()))
                if stop and keys:
                    return
                last = keys[-1] if keys else last

        return first

    alone = spark.newSession()
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        alone.conf.set(f"spark.sql.files.{setting}", str(_ONE_FILE))
    found: dict[str, str] = {}
    for stop in (True, False):
        left = [path for key, path in files.items() if key not in found]
        if left:
            lines = alone.read.text(left).select(
                F.col("_metadata.file_path").alias("key"), F.col("_metadata.file_block_start").alias("start"), "value"
            )
            rows = lines.mapInArrow(heads(stop), lines.schema).select("key", "value").collect()
            found |= {r.key: r.value.removeprefix("\ufeff") for r in rows}
    return found


def layouts(spark: SparkSession, directory: str, include: Sequence[str] | None = None, glob: str = "*.csv") -> list[list[str]]:
    """The files of a folder, grouped by their header; groups and files in the order of sheet names."""
    files = sorted(sheet_files(spark, directory, glob).collect(), key=lambda r: (r.sheet, r.path))
    wanted = set(pick_sheets(sorted({r.sheet for r in files}), include))
    filled = {r.key: r.path for r in files if r.sheet in wanted and r.bytes > 0}
    heads = first_lines(spark, filled) if filled else {}
    groups: dict[str, list[str]] = {}
    for key, path in filled.items():
        if key in heads:
            groups.setdefault(heads[key], []).append(path)
    return list(groups.values())


def read_layout(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files of one layout as text columns, with the sheet each row came from: one scan."""
    rows = spark.read.option("header", True).csv(list(paths))
    return rows.select("*", sheet_name(F.col("_metadata.file_path")).alias("source_sheet"))


def read_sheets(
    spark: SparkSession, directory: str, include: Sequence[str] | None = None
) -> DataFrame:
    """Every CSV sheet of a folder as text columns; headers may differ by sheet.

    A sheet is a file, or a folder of part files. The plan has one scan per header, however many files.
    """
    scans = [read_layout(spark, paths) for paths in layouts(spark, directory, include)]
    if not scans:
        raise ValueError("no sheets to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


# --- sales history -------------------------------------------------------------------


def _first(df: DataFrame, names: Sequence[str]) -> Column | None:
    return next((F.col(f"`{n}`") for n in names if n in df.columns), None)


def history_from_clean(df: DataFrame, default_channel: str = "sales") -> DataFrame:
    """Sale date, sku, channel, quantity and revenue from cleaned sales lines."""
    date = _first(df, ("sale_date", "InvDate"))
    if date is None:
        raise ValueError("no sale date column: need sale_date or InvDate")
    skus = [text.strip(F.col(c)) for c in ("ItemCode", "Product") if c in df.columns]
    if not skus:
        raise ValueError("no sku column: need ItemCode or Product")
    channel = _first(df, ("source_sheet",))
    quantity, revenue = _first(df, ("Quantity",)), _first(df, ("usd_adjusted_total", "Total"))
    zero = F.lit(0.0)
    history = df.select(
        any_date(date).alias("sale_date"),
        F.coalesce(*skus, F.lit(fixed.UNSPECIFIED_SKU)).alias("sku"),
        F.coalesce(
            text.strip(channel) if channel is not None else F.lit(None), F.lit(default_channel)
        ).alias("channel"),
        (number_or_zero(quantity) if quantity is not None else zero).alias("quantity"),
        (number_or_zero(revenue) if revenue is not None else zero).alias("revenue"),
    )
    return history.filter(F.col("sale_date").isNotNull())


def history_channel(name: str) -> str:
    """Channel by file name."""
    return next(
        (channel for mark, channel in fixed.HISTORY_CHANNELS if mark in name),
        fixed.HISTORY_DEFAULT_CHANNEL,
    )


def sheet_channel(name: Column) -> Column:
    """Channel by file name, as a column."""
    marks = [F.when(F.contains(name, F.lit(mark)), channel) for mark, channel in fixed.HISTORY_CHANNELS]
    return F.coalesce(*marks, F.lit(fixed.HISTORY_DEFAULT_CHANNEL))


def history_from_sheet(df: DataFrame, name: str) -> DataFrame | None:
    """History rows of one source file, or None when a needed column is missing."""
    return history_rows(df, F.lit(history_channel(name)))


def history_rows(df: DataFrame, channel: Column) -> DataFrame | None:
    """History rows of files with one header, or None when a needed column is missing.

    The first alias present is taken for each of date, sku, quantity and revenue.
    """
    date, sku = _first(df, fixed.HISTORY_DATE_NAMES), _first(df, fixed.HISTORY_SKU_NAMES)
    quantity = _first(df, fixed.HISTORY_QUANTITY_NAMES)
    revenue = _first(df, fixed.HISTORY_REVENUE_NAMES)
    if date is None or sku is None or quantity is None:
        return None
    day = F.coalesce(any_date(date), date_like(F.concat(date.cast("string"), F.lit("/01")), "yyyy/MM/dd"))
    return df.select(
        day.alias("sale_date"),
        sku.cast("string").alias("sku"),
        channel.alias("channel"),
        clip_negative(number_or_zero(quantity)).alias("quantity"),
        (number_or_zero(revenue) if revenue is not None else F.lit(0.0)).alias("revenue"),
    ).filter(F.col("sale_date").isNotNull())


def history_from_sheets(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """One history from files with different headers; incomplete ones are left out."""
    return _usable([history_from_sheet(df, n) for n, df in sheets.items()])


def _usable(parts: Sequence[DataFrame | None]) -> DataFrame:
    usable = [h for h in parts if h is not None]
    if not usable:
        raise ValueError("no usable sales history files")
    return reduce(DataFrame.unionByName, usable)


def history_from_folder(spark: SparkSession, folder: str) -> DataFrame:
    """One history from the CSV files of a folder: one scan per header; files without a needed column are left out."""
    scans = [read_layout(spark, paths) for paths in layouts(spark, folder)]
    return _usable([history_rows(df, sheet_channel(F.col("source_sheet"))) for df in scans])


def load_history(spark: SparkSession, parquet: str | None, csv_folder: str) -> DataFrame:
    """Cleaned Parquet when it exists, otherwise the CSV files of a folder."""
    if parquet is not None:
        try:
            return history_from_clean(spark.read.parquet(parquet))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return history_from_folder(spark, csv_folder)


# --- lookups and runs ------------------------------------------------------------------


def read_clean_sales(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_lookup(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    lookup = spark.read.option("header", True).csv(path)
    missing = [c for c in required if c not in lookup.columns]
    if missing:
        raise ValueError(f"{path} lacks: {', '.join(missing)}")
    return lookup


def latest_run(runs: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows of the latest run; the run id sorts by time.

    With ``run`` as a partition column both the maximum and the filter read
    folders, not files.
    """
    newest = runs.agg(F.max(run).alias(run))
    return runs.filter(F.col(run) == newest.scalar())


def prefer_combined(combined: DataFrame, forecasts: DataFrame, run: str = "run_id") -> DataFrame:
    """The latest run, from its combined table when it has one."""
    newest = forecasts.agg(F.max(run).alias(run)).scalar()
    both = combined.withColumn("_own", F.lit(1)).unionByName(
        forecasts.withColumn("_own", F.lit(0)), allowMissingColumns=True
    ).filter(F.col(run) == newest)
    best = both.agg(F.max("_own").alias("_own")).scalar()
    return both.filter(F.col("_own") == best).drop("_own")


def read_mart(spark: SparkSession, name: str, order: Sequence[str]) -> DataFrame:
    """A warehouse table in its documented order."""
    return spark.table(name).orderBy(*order)
