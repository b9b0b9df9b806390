"""Connected components of a table of links, by alternating large and small stars.

Each round is two aggregations and two joins over the links and is written to the
shared folder. The rounds end when the links are stars, which takes one aggregation to see
instead of another round. Hot nodes are pre-aggregated before the shuffle, and the join that
hands their minimum back is one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import settle


def _with_minimum(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(least.select("a", F.least("least", "a").alias("least")), "a")


def _each(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """a, b: several links of each row, made in one pass over it."""
    made = F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs))
    return rows.select(F.explode(made).alias("link")).select("link.*")


def _large(links: DataFrame) -> DataFrame:
    return _with_minimum(_each(links, ("a", "b"), ("b", "a"))).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    return _each(_with_minimum(down), ("b", "least"), ("a", "least")).where("a <> b").distinct()


def _stars(links: DataFrame) -> DataFrame:
    """node, component (a smaller node linked with it, if any), done (there is one at most, and it has none itself)."""
    ends = _each(links.withColumn("none", F.lit(None).cast("long")), ("a", "b"), ("b", "none"))
    centre = F.max(F.col("b").isNull())
    done = F.min("b").isNull() | ((F.min("b") == F.max("b")) & ~centre)
    return ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"), done.alias("done"))


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, component): the smallest node reachable, for every node with a link to another one."""
    rows = settle(links.select("a", "b").where("a <> b").distinct())
    while True:
        rows = settle(_large(_small(rows)))
        stars = settle(_stars(rows))
        if stars.where("not done").isEmpty():
            return stars.where("component is not null").select("node", "component")
