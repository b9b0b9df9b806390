"""Data-quality checks and profiles.

Checks return rows (rule, failures) or the failing rows, so they can be stored;
``require`` turns failures into an error.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .quantiles import quantiles


class QualityError(ValueError):
    """A data-quality rule failed."""


def _long(one_row: DataFrame, name: str, fields: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row of measures to one row per measured thing."""
    structs = [
        F.struct(F.lit(key).alias(name), *[c.alias(n) for n, c in parts.items()])
        for key, parts in fields.items()
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(counts, "rule", {f"not_null_{c}": {"failures": F.col(c)} for c in columns})


def require(checks: DataFrame) -> None:
    """Raise when a rule has failures. There are as many rows as rules."""
    failed = [f"{r.rule}: {r.failures}" for r in checks.filter(F.col("failures") > 0).collect()]
    if failed:
        raise QualityError("; ".join(failed))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once. Counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def unaccepted(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list, with their counts."""
    bad = df.filter(F.col(column).isNull() | ~F.col(column).isin(*accepted))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct values of a reference that the parent does not have."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def reconcile(df: DataFrame, slice_column: str, measure: str) -> DataFrame:
    """Slices next to the total they must add up to.

    One pass: the total is a grouping set of the same aggregate.
    """
    both = df.groupingSets([[F.col(slice_column)], []], F.col(slice_column)).agg(
        F.grouping_id().alias("_level"), F.sum(measure).alias("_sum"), F.count("*").alias("_rows")
    )
    slices, total = F.col("_level") == 0, F.col("_level") == 1
    return both.agg(
        F.count_if(slices).alias("slices"),
        F.sum(F.when(slices, F.col("_sum"))).alias("slice_sum"),
        F.sum(F.when(total, F.col("_sum"))).alias("total"),
        F.sum(F.when(slices, F.col("_rows"))).alias("slice_rows"),
        F.sum(F.when(total, F.col("_rows"))).alias("total_rows"),
    ).withColumn("matches", (F.col("slice_sum") == F.col("total")) & (F.col("slice_rows") == F.col("total_rows")))


def manifest(df: DataFrame, sheet: str = "source_sheet", columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per sheet and a hash of ``columns`` (default: all) that does not depend on their order.

    The hash is a sum over rows, so that a repeated row changes it. A cell goes in with
    its length, a missing one as a mark of its own.
    """
    cells = [F.col(c).cast("string") for c in columns or df.columns]
    marked = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]
    number = F.conv(F.substring(F.md5(F.concat_ws("|", *marked)), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.groupBy(sheet).agg(
        F.count("*").alias("rows"), F.sum(number).cast("decimal(38,0)").cast("string").alias("content_hash")
    )


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that repeat another row in the given columns, and their share."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("n"))
    return groups.agg(
        F.sum("n").alias("rows"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
        F.round(F.sum(F.col("n") - 1) / F.sum("n"), 6).alias("duplicate_ratio"),
    )


def anomalies(series: DataFrame, keys: Sequence[str], measure: str, limit: float = 3.0) -> DataFrame:
    """Points of a series further than ``limit`` standard deviations from its mean.

    Input is one row per key and period.
    """
    whole = Window.partitionBy(*keys)
    mean, sd = F.avg(measure).over(whole), F.stddev(measure).over(whole)
    scored = series.withColumn("z_score", F.try_divide(F.col(measure) - mean, sd))
    return scored.filter(F.abs("z_score") > limit)


def feature_checks(df: DataFrame, features: Sequence[str], date: str, cutoff: str) -> DataFrame:
    """Per feature: missing values, no variance; and rows at or past the cutoff."""
    measures = []
    for c in features:
        measures += [F.count_if(F.col(c).isNull()).alias(f"{c}_null"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    late = F.count_if(F.col(date) >= F.lit(cutoff).cast("date")).alias("_late")
    one = df.agg(F.count("*").alias("_rows"), late, *measures)
    return _long(
        one,
        "feature",
        {
            c: {
                "rows": F.col("_rows"),
                "missing": F.col(f"{c}_null"),
                "constant": F.coalesce(F.col(f"{c}_min") == F.col(f"{c}_max"), F.lit(True)),
                "late_rows": F.col("_late"),
            }
            for c in features
        },
    )


def audit(tables: Mapping[str, tuple[DataFrame, str]], run_id: str) -> DataFrame:
    """Rows and latest date of every table of a run."""
    parts = [
        df.agg(F.count("*").alias("rows"), F.max(date).cast("date").alias("latest")).select(
            F.lit(run_id).alias("run_id"), F.lit(name).alias("table_name"), "rows", "latest"
        )
        for name, (df, date) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- profiles ----------------------------------------------------------------------------


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, as count and percent."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    share = {c: F.round(F.try_divide(F.col(c) * 100, F.col("_n")), 4) for c in names}
    return _long(
        counts, "column_name", {c: {"missing_count": F.col(c), "missing_percent": share[c]} for c in names}
    )


def drop_sparse(df: DataFrame, percent: float = 90.0) -> DataFrame:
    """Drop columns with more missing values than ``percent``. One aggregate row decides."""
    rows = null_profile(df).filter(F.col("missing_percent") > percent).collect()
    return df.drop(*[r.column_name for r in rows])


def inject_nulls(df: DataFrame, column: str, keys: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Null a share of a column, chosen by a hash of the row's keys.

    A repeated task makes the same choice, which a random number would not.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(column, F.when(draw >= int(share * 2**32), F.col(column)))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, spread, range and distinct values, one row per column, exact, in one scan.

    Every row becomes one (column, value) pair per column, so that the distinct counts of all columns
    are one aggregate by column and value, and equal values combine before the shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"), F.col(c).cast("string").alias("s")) for c in columns])
    values = df.select(F.inline(pairs))
    total = F.sum(F.col("v").cast("decimal(18,4)")).cast("double")
    return values.groupBy("column_name").agg(
        F.count("v").alias("values"),
        F.round(F.try_divide(total, F.count("v").cast("double")), 4).alias("mean"),
        F.round(F.stddev("v"), 4).alias("stddev"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
        F.count_distinct("s").alias("distinct_values"),
    )


#: Buckets of a distinct-count sketch, as a power of two, and its relative standard error.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys, column_name, rows (known values), sketch: a distinct-count sketch of every column, all in one pass.

    A sketch has a bounded size. Sketches of days, files or partitions can be stored and merged later,
    without the rows they come from.
    """
    counts = [F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)]
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(f"_s{i}") for i, c in enumerate(columns)]
    parts = df.groupBy(*keys).agg(*counts, *sketches)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("rows"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return parts.select(*keys, F.inline(rows))


def merge_sketches(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, column_name, rows, sketch: stored sketches merged to coarser keys; ``distinct_estimate`` reads them."""
    return stored.groupBy(*keys, "column_name").agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketch: Column) -> Column:
    """Distinct values of a sketch, in 997 of 1000 cases within three times ``SKETCH_ERROR``."""
    return F.hll_sketch_estimate(sketch)


def histogram(df: DataFrame, column: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per bin of equal width."""
    low = F.floor(F.col(column) / width) * width
    return df.groupBy(*keys, low.cast("double").alias("bin_start")).agg(F.count("*").alias("rows"))


def box_stats(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers and outliers per key, exact for measures with any number of values."""
    quartiles = [F.col("q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    boxes = settle(quantiles(df, keys, column, (0.25, 0.5, 0.75)).select(*keys, "lowest", *quartiles, "highest"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    outside = ~F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    values = df.filter(F.col(column).isNotNull()).select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(column).cast("double").alias("_v"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.lit(True))
    names = [*keys, "lowest", "q1", "median", "q3", "highest"]
    return values.join(boxes, same).groupBy(*names).agg(F.count_if(outside).alias("outliers"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
