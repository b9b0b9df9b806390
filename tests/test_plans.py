"""Plan shapes that must hold at any scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerline import session
from ledgerline.operators import subscription as sub
from ledgerline.plans import subscription

from .conftest import SF


@pytest.fixture()
def large(spark):
    """As if every table were too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NAMES = [
    "adoption_scorecard", "customer_tiers", "logo_churn", "retention", "clean_sales", "quarterly_dataset",
    "baseline_forecast", "forecast_mart", "qty_ma3", "forward_fill", "dq_fk", "backtest", "replace_partition",
]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_joins(large, name):
    text = plan(entry.queries()[name](large, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scan_reads_only_what_is_used(spark):
    text = plan(entry.queries()["family_summary"](spark, SF))
    scan = next(line for line in text.splitlines() if "lineitem" in line)
    assert "l_tax" not in scan and "l_comment" not in scan and "l_shipdate" not in scan


def test_unneeded_tables_are_not_joined(spark):
    text = plan(entry.queries()["suite_split"](spark, SF))
    assert "orders" in text and "customer.parquet" not in text and "part.parquet" not in text


def test_leaders_are_broadcast_not_shuffled(spark):
    text = plan(entry.queries()["adoption_scorecard"](spark, SF))
    assert "hashpartitioning(customer" not in text


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["top5_customers"](spark, SF))
    assert "TakeOrderedAndProject" in plan(entry.queries()["country_top20"](spark, SF))


def test_the_order_grain_is_grouped_where_the_order_join_puts_the_lines(large):
    """the lines are not shuffled once more for the grain, also when the products are too many to broadcast."""
    lines = subscription.subs(large, SF, "customer", "order_id", "region", "quantity")
    text = plan(lines.groupBy("month", "service_family", "plan_variant", "region", "customer", "order_id").count())
    assert "hashpartitioning(order_id" in text
    assert "hashpartitioning(month" not in text


def test_tiers_are_looked_up_without_a_shuffle_of_the_grain(spark):
    grain = sub.order_grain(subscription.subs(spark, SF, "customer", "order_id", "region", "quantity"))
    assert "hashpartitioning(customer" not in plan(sub.with_tier(grain))


def test_partitions_follow_the_rows_while_something_is_written(spark):
    """a task's memory does not grow with the tables."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(key) for key in keys]
    with session.sized(spark, 40 * session.TASK_ROWS + 1):
        assert [spark.conf.get(key) for key in keys] == ["41", session.READ_BYTES, session.JOINED_BYTES]
        assert ", 41)" in plan(spark.range(100).groupBy(F.col("id") % 7).count())
    assert [spark.conf.get(key) for key in keys] == before
    with session.sized(spark, 1000):
        assert [spark.conf.get(key) for key in keys] == before
