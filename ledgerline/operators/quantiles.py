"""Exact order statistics of measures with any number of values, by distributed selection.

A wanted rank lies in an interval of values. Each round counts the rows of the open
intervals between a few cut points, keeps the part that holds the rank, and drops all
other rows. Counts are exact, so the answer does not depend on how well the cut points
were chosen; a mergeable sketch chooses them. No buffer holds the values of a key.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

#: Cut points of an interval per round, and the size of the sketch behind them.
CUTS, ACCURACY = 31, 500
#: Rows of an interval that are counted value by value at last.
FEW = 20_000


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Key columns equal to their prefixed copies; missing keys are a key."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(prefix + k))
    return out


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def _inside(values: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the open intervals, with the interval's bounds."""
    bounds = _renamed(intervals.select(*keys, "low", "high"), keys, "_of_")
    joined = values.select(*keys, "v").join(bounds, _same(keys, "_of_") & F.col("v").between(F.col("low"), F.col("high")))
    return joined.select(*keys, "v", "low", "high")


def _narrowed(rows: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Targets (keys, rank, low, high, below) in the part of their interval that holds their rank.

    Parts are the cut points themselves, which settle a rank, and what lies between two of them.
    """
    at = [*keys, "low", "high"]
    shares = F.array(*[F.lit(i / (CUTS + 1)) for i in range(1, CUTS + 1)])
    cuts = settle(rows.groupBy(*at).agg(F.array_sort(F.array_distinct(F.percentile_approx("v", shares, F.lit(ACCURACY)))).alias("cuts")))
    cut = _renamed(cuts, at, "_of_")
    less = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    part = 2 * less + F.when(F.get("cuts", less) == F.col("v"), 1).otherwise(0)
    parts = rows.join(cut, _same(at, "_of_")).groupBy(*at, part.alias("part"))
    parts = parts.agg(F.count("*").alias("held"), F.min("v").alias("least"), F.max("v").alias("most"))
    so_far = Window.partitionBy(*at).orderBy("part")  # twice as many rows as cut points
    parts = parts.withColumn("upto", F.sum("held").over(so_far)).drop("part")
    found = targets.drop("held").join(_renamed(parts, at, "_of_"), _same(at, "_of_"))
    place = F.col("rank") - F.col("below")
    found = found.filter((place < F.col("upto")) & (place >= F.col("upto") - F.col("held")))
    return found.select(
        *keys, "rank", F.col("least").alias("low"), F.col("most").alias("high"),
        (F.col("below") + F.col("upto") - F.col("held")).alias("below"), "held",
    )


def _counted(rows: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Targets whose intervals have few rows, settled by counting values."""
    at = [*keys, "low", "high"]
    counts = rows.groupBy(*at, "v").agg(F.count("*").alias("held"))
    upto = F.sum("held").over(Window.partitionBy(*at).orderBy("v"))
    counts = counts.withColumn("upto", upto)
    found = targets.drop("held").join(_renamed(counts, at, "_of_"), _same(at, "_of_"))
    place = F.col("rank") - F.col("below")
    found = found.filter((place < F.col("upto")) & (place >= F.col("upto") - F.col("held")))
    return found.select(*keys, "rank", F.col("v").alias("value"))


def order_statistics(values: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, rank, value: the value at each wanted rank (from 0, in ascending order) of a key.

    ``values`` has the keys and v, without nulls; ``wanted`` the keys, rank, and of the key's values
    the least (low), the greatest (high) and the number (held).
    """
    targets = settle(wanted.select(*keys, F.col("rank").cast("long"), "low", "high", F.lit(0).cast("long").alias("below"), "held").distinct())
    rows, found = values, []
    while True:
        apart = F.col("low") < F.col("high")
        few, many = targets.filter(apart & (F.col("held") <= FEW)), targets.filter(apart & (F.col("held") > FEW))
        found.append(targets.filter(~apart).select(*keys, "rank", F.col("low").alias("value")))
        inside = _inside(rows, few.select(*keys, "low", "high").distinct(), keys)
        found.append(settle(_counted(inside, few, keys)))
        if many.isEmpty():
            return reduce(DataFrame.unionByName, found)
        inside = _inside(rows, many.select(*keys, "low", "high").distinct(), keys)
        targets = settle(_narrowed(inside, many, keys))
        # later rounds read the kept rows only, each with its interval
        kept = targets.filter("low < high").select(*keys, "low", "high").distinct()
        rows = settle(_inside(rows, kept, keys))


def quantiles(df: DataFrame, keys: Sequence[str], column: str, shares: Sequence[float]) -> DataFrame:
    """keys, n, lowest, highest and q (one value per share) of the column's known values, exact, between two values linear."""
    values = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("v"))
    totals = settle(values.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lowest"), F.max("v").alias("highest")))
    places = F.array(*[F.lit(float(s)) * (F.col("n") - 1) for s in shares])
    spots = totals.select(*keys, "n", "lowest", "highest", F.posexplode(places).alias("nth", "place"))
    spots = spots.withColumns({"down": F.floor("place").cast("long"), "part": F.col("place") - F.floor("place")})
    up = F.least(F.col("down") + 1, F.col("n") - 1)
    wanted = spots.select(
        *keys, F.explode(F.array(F.col("down"), up)).alias("rank"), F.col("lowest").alias("low"), F.col("highest").alias("high"), F.col("n").alias("held")
    )
    stats = order_statistics(values, wanted, keys)
    for name, rank in (("_down", F.col("down")), ("_up", up)):
        of = _renamed(stats, keys, "_of_").select(*[f"_of_{k}" for k in keys], F.col("rank").alias("_rank"), F.col("value").alias(name))
        spots = spots.join(of, _same(keys, "_of_") & (rank == F.col("_rank"))).drop("_rank", *[f"_of_{k}" for k in keys])
    value = F.col("_down") + (F.col("_up") - F.col("_down")) * F.col("part")
    lists = spots.groupBy(*keys, "n", "lowest", "highest").agg(F.array_sort(F.collect_list(F.struct("nth", value.alias("value")))).alias("_q"))
    return lists.select(*keys, "n", "lowest", "highest", F.transform("_q", lambda x: x["value"]).alias("q"))
