"""Writing sheets, marts, forecasts and partition-level loads."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..functions import text
from ..functions.numbers import clip_negative
from ..session import settle

FORMATS = ("csv", "parquet")


# --- sheets ----------------------------------------------------------------------------


def unique_tokens(spark: SparkSession, names: Sequence[str]) -> dict[str, str]:
    """A distinct token per sheet, numbered in arrival order until it is free."""
    listed = spark.createDataFrame(list(enumerate(names)), "place int, name string")
    bases = listed.select("name", text.sheet_token(F.col("name")).alias("base")).orderBy("place").collect()
    tokens: dict[str, str] = {}
    for name, base in bases:
        token, nth = base, 1
        while token in tokens.values():
            nth += 1
            token = f"{base}_{nth}"
        tokens[name] = token
    return tokens


def writer(df: DataFrame, kind: str, mode: str = "overwrite"):
    """A writer for one of the supported formats."""
    if kind not in FORMATS:
        raise ValueError(f"unsupported format '{kind}', expected one of {', '.join(FORMATS)}")
    out = df.write.format(kind).mode(mode)
    return out.option("header", True) if kind == "csv" else out


def write_sheets(
    sheets: Mapping[str, DataFrame], folder: str, kind: str = "csv", row_number: str | None = None
) -> dict[str, str]:
    """One output folder per sheet. Returns sheet name to path.

    ``row_number`` names an extra column with a row id, increasing but not dense.
    """
    if not sheets:
        return {}
    spark = next(iter(sheets.values())).sparkSession
    paths = {name: f"{folder}/{token}" for name, token in unique_tokens(spark, list(sheets)).items()}
    for name, df in sheets.items():
        if row_number:
            df = df.select(F.monotonically_increasing_id().alias(row_number), "*")
        writer(df, kind).save(paths[name])
    return paths


def write_by_sheet(df: DataFrame, path: str, column: str = "source_sheet") -> None:
    """All sheets in one pass, a partition folder each; readers prune by sheet."""
    writer(df, "parquet").partitionBy(column).save(path)


# --- projections and schemas ------------------------------------------------------------


def write_projected(df: DataFrame, path: str, columns: Sequence[str] = fixed.EXPORT_COLUMNS) -> list[str]:
    """Write the wanted columns that exist; returns them."""
    kept = [c for c in columns if c in df.columns]
    writer(df.select(*kept), "parquet").save(path)
    return kept


def conform(df: DataFrame, schema: str | T.StructType, **literals: str) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones null, run metadata as literals, bad cells null."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def column(field: T.StructField) -> Column:
        if field.name in literals:
            value = F.lit(literals[field.name])
        elif field.name in df.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        return value.try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in target.fields])


def prepare_forecast(
    df: DataFrame, cohort: str, run_id: str, model_name: str, model_version: str
) -> DataFrame:
    """Forecast rows ready for the mart: defaults, month end, clipped values, stamp."""
    def existing(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in df.columns else default

    sku, channel = F.lit(f"{cohort.upper()}_ALL"), F.lit(cohort)
    date = existing("forecast_date", F.col("sale_month") if "sale_month" in df.columns else F.lit(None))
    measures = [c for c in ("forecast_quantity", "forecast_revenue") if c in df.columns]
    filled = df.withColumns(
        {"sku": existing("sku", sku), "channel": existing("channel", channel), "forecast_date": date.try_cast("date")}
    )
    dated = filled.filter(F.col("forecast_date").isNotNull()).withColumns(
        {
            "sale_month": F.last_day(
                F.coalesce(F.col("sale_month").try_cast("date"), F.col("forecast_date"))
                if "sale_month" in df.columns else F.col("forecast_date")
            ),
            "created_at": F.current_timestamp(),
            **{c: clip_negative(F.col(c).try_cast("double")) for c in measures},
        }
    )
    return conform(
        dated, fixed.FORECAST_MART, forecast_run_id=run_id, cohort=cohort,
        model_name=model_name, model_version=model_version,
    )


# --- loads ---------------------------------------------------------------------------------


def replace_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows without the incoming key groups, then the incoming rows.

    The key groups are run metadata: a handful of values, whatever the row count.
    They are settled, so that Spark broadcasts them and the existing rows are not
    shuffled by a key that has few values.
    """
    arriving = settle(incoming.select(*keys).distinct())
    return existing.join(arriving, list(keys), "left_anti").unionByName(
        incoming, allowMissingColumns=True
    )


def load_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Idempotent load: partitions present in ``df`` are replaced, others stay."""
    writer(df, "parquet").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).save(path)


def refresh(df: DataFrame, path: str) -> bool:
    """Replace a whole table. An empty frame changes nothing and returns False."""
    if df.isEmpty():
        return False
    writer(df, "parquet").save(path)
    return True


def write_forecast(df: DataFrame, folder: str, run_id: str, name: str, method: str, **settings: object) -> None:
    """Forecast CSV and a one-row JSON of metadata next to it."""
    writer(df, "csv").save(f"{folder}/{name}_forecast_{run_id}")
    metadata(df, run_id, method, **settings).write.mode("overwrite").json(f"{folder}/{name}_meta_{run_id}")


def metadata(df: DataFrame, run_id: str, method: str, **settings: object) -> DataFrame:
    return df.agg(F.count("*").alias("record_count")).select(
        F.lit(run_id).alias("generated_at"),
        F.lit(method).alias("method"),
        *[F.lit(str(v)).alias(k) for k, v in settings.items()],
        "record_count",
    )


def write_suites(df: DataFrame, path: str) -> None:
    """One folder per suite in a single pass; suites without rows do not appear."""
    writer(df, "parquet").partitionBy("suite").save(path)


def export_marts(marts: Mapping[str, tuple[DataFrame | None, Sequence[str]]], folder: str) -> list[str]:
    """Every mart as sorted CSV; a missing one is skipped. Returns what was written."""
    written = []
    for name, (df, order) in marts.items():
        if df is not None:
            writer(df.orderBy(*order), "csv").save(f"{folder}/{name}")
            written.append(name)
    return written


def materialise(df: DataFrame, table: str, views: Mapping[str, Sequence[str]], channel: str = "channel") -> None:
    """A saved table and one view per suite over it."""
    df.write.mode("overwrite").saveAsTable(table)
    stored = df.sparkSession.table(table)
    for view, members in views.items():
        stored.filter(F.col(channel).isin(*members)).createOrReplaceTempView(view)
