"""Window operators on series.

Two shapes occur. Monthly and quarterly series have one row per key and period,
so a window per key is bounded by the calendar. Row-level series are not: a key,
or one day of it, may hold a third of all rows. Those run in blocks of the sorted
rows: a window per key and block does the bulk, and a second step over one or a
few rows per block passes state from block to block.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numbers import mean
from ..session import settle


def rolling_mean(
    monthly: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str], rows: int
) -> DataFrame:
    """Mean of the last ``rows`` rows of a key, fewer at the start."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)
    means = {f"{m}_mean": mean(F.sum(m).over(frame), F.count(m).over(frame)) for m in measures}
    return monthly.withColumns(means)


def last_rows(monthly: DataFrame, keys: Sequence[str], order: str, rows: int) -> DataFrame:
    """The latest ``rows`` rows of every key; Spark cuts them before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return monthly.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= rows).drop("_age")


def tail_mean(
    monthly: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str], rows: int
) -> DataFrame:
    """Mean of the latest ``rows`` rows per key, with the last period."""
    return (
        last_rows(monthly, keys, order, rows)
        .groupBy(*keys)
        .agg(
            F.max(order).alias("last_period"),
            *[mean(F.sum(m), F.count(m)).alias(f"{m}_mean") for m in measures],
        )
    )


def blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_place``, which ascends by ``keys`` and ``order`` over the whole table, and ``_block``.

    A block is a range of the sorted rows, so one key, or one day of one key, has as many blocks as its
    rows need. Rows that are equal in all columns of the order are dealt to several blocks as well. The
    sorted rows are written, so that places stay the same when a task is repeated.
    """
    by = [*keys, *order, "_draw"]
    ranged = df.withColumn("_draw", F.rand(11)).repartitionByRange(*by).sortWithinPartitions(*by).drop("_draw")
    placed = settle(ranged.withColumn("_place", F.monotonically_increasing_id()))
    return placed.withColumn("_block", F.shiftright("_place", 33))  # the number of the partition


def moving_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], measure: str, rows: int, name: str
) -> DataFrame:
    """Mean of a row and the ``rows - 1`` before it, over rows of any number.

    Inside a block all but the first rows see their whole frame. The first and last rows of the
    blocks, at most ``2 * (rows - 1)`` per key and block, go through a second window that hands
    them over the boundaries.
    """
    in_block = Window.partitionBy(*keys, "_block").orderBy("_place")
    across = Window.partitionBy(*keys).orderBy("_place")

    def average(spec: WindowSpec) -> Column:
        frame = spec.rowsBetween(-(rows - 1), 0)
        return mean(F.sum(measure).over(frame), F.count(measure).over(frame))

    placed = blocks(df, keys, order).withColumns(
        {
            "_nth": F.row_number().over(in_block),
            "_ends": F.lead(F.lit(1), rows - 1).over(in_block).isNull(),
            name: average(in_block),
        }
    )
    whole = placed.filter(F.col("_nth") >= rows)
    edges = placed.filter((F.col("_nth") < rows) | F.col("_ends")).withColumn(name, average(across))
    return whole.unionByName(edges.filter(F.col("_nth") < rows)).select(*df.columns, name)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], measure: str) -> DataFrame:
    """Nulls take the last value before them in the order of a key.

    A prefix scan in three steps: every block is filled on its own, the last values of the blocks
    are scanned per key, one row per block, and carried to where a block starts empty.
    """
    placed = blocks(df, keys, order)
    so_far = Window.partitionBy(*keys, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    filled = placed.withColumn("_filled", F.last(measure, ignorenulls=True).over(so_far))
    known = F.col(measure).isNotNull()
    ends = placed.groupBy(*keys, "_block").agg(F.max_by(F.when(known, F.col(measure)), F.when(known, F.col("_place"))).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).filter(F.col("_carried").isNotNull())
    carried = settle(carried.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_block").alias("_at"), "_carried"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    joined = filled.join(carried, [F.col("_block") == F.col("_at"), *same], "left")
    return joined.withColumn(measure, F.coalesce("_filled", "_carried")).select(*df.columns)


def log_seasonal_diff(monthly: DataFrame, keys: Sequence[str], order: str, measure: str, season: int = 12) -> DataFrame:
    """Log, its first difference and the seasonal difference of that."""
    spec = Window.partitionBy(*keys).orderBy(order)
    logged = monthly.withColumn("log_value", F.log(F.greatest(F.col(measure).cast("double"), F.lit(1.0))))
    first = logged.withColumn("diff_1", F.col("log_value") - F.lag("log_value", 1).over(spec))
    return first.withColumn("diff_seasonal", F.col("diff_1") - F.lag("diff_1", season).over(spec))


def autocorrelation(
    series: DataFrame, keys: Sequence[str], order: str, measure: str, lags: int = 4
) -> DataFrame:
    """Autocorrelation of each series at lags 1 to ``lags``."""
    whole, spec = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(order)
    known = series.filter(F.col(measure).isNotNull())
    centred = known.withColumn("_x", F.col(measure) - F.avg(measure).over(whole))
    lagged = centred.withColumns({f"_x{k}": F.lag("_x", k).over(spec) for k in range(1, lags + 1)})
    sums = lagged.groupBy(*keys).agg(
        F.sum(F.col("_x") * F.col("_x")).alias("_v"),
        *[F.sum(F.col("_x") * F.col(f"_x{k}")).alias(f"_c{k}") for k in range(1, lags + 1)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_c{k}"), F.col("_v")).alias("acf"))
            for k in range(1, lags + 1)
        ]
    )
    return sums.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.lag", "_r.acf")


def running_total(monthly: DataFrame, keys: Sequence[str], order: str, measure: str, name: str) -> DataFrame:
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumn(name, F.sum(measure).over(so_far))
