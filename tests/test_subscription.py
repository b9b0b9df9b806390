import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest

from ledgerline.functions import fixed_values as fixed
from ledgerline.operators import subscription as sub
from tests.conftest import SF

PAID = "month date, customer string, family string, revenue decimal(21,7)"


def month_end(i):
    return (pd.Timestamp("2023-01-31") + pd.offsets.MonthEnd(i)).date()


def random_paid(seed, months=9, customers=12):
    rng = random.Random(seed)
    skipped = rng.randrange(1, months - 1)  # a month without any row
    rows = []
    for c in range(customers):
        for f in "XY":
            for m in range(months):
                if m != skipped and rng.random() < 0.6:
                    rows.append((month_end(m), f"c{c}", f, Decimal(rng.choice([0, 5, 10, 12, 30]))))
    return rows


def by_pivot(rows):
    """The wide form: one column per observed month."""
    pdf = pd.DataFrame(rows, columns=["month", "customer", "family", "revenue"])
    pdf["revenue"] = pdf["revenue"].astype(float)
    wide = pdf.pivot_table(index=["customer", "family"], columns="month", values="revenue", aggfunc="sum").fillna(0.0)
    out = {}
    for prev, cur in zip(wide.columns[:-1], wide.columns[1:]):
        p, c = wide[prev], wide[cur]
        out[cur] = (
            int(((p <= 0) & (c > 0)).sum()), int(((p > 0) & (c <= 0)).sum()),
            float(p.combine(c, min).sum()), float((c - p).clip(lower=0).sum()),
            float((p - c).clip(lower=0).sum()), float(c.sum() - p.sum()),
        )
    return out


@pytest.mark.parametrize("seed", range(6))
def test_churn_equals_the_wide_form(spark, seed):
    rows = random_paid(seed)
    paid = spark.createDataFrame(rows, PAID)
    logos = {r.snapshot_month: r for r in sub.logo_churn(paid).collect()}
    money = {r.snapshot_month: r for r in sub.revenue_churn(paid).collect()}
    expected = by_pivot(rows)
    assert set(logos) == set(money) == set(expected)
    for month, (new, gone, kept, gain, lost, net) in expected.items():
        r, m = logos[month], money[month]
        assert (r.new_logos, r.churned_logos, r.net_logos) == (new, gone, new - gone)
        assert (m.kept_revenue, m.expansion_revenue, m.churned_revenue, m.net_change) == (kept, gain, lost, net)
        assert m.contraction_revenue == m.churned_revenue


def test_churn_needs_two_months(spark):
    paid = spark.createDataFrame([(month_end(0), "a", "X", Decimal(1))], PAID)
    assert sub.logo_churn(paid).count() == 0


def test_retention(spark):
    rows = [
        (month_end(0), "a", "X", Decimal(0)), (month_end(1), "a", "X", Decimal(5)), (month_end(3), "a", "X", Decimal(5)),
        (month_end(0), "b", "X", Decimal(5)), (month_end(1), "b", "X", Decimal(5)),
    ]
    got = {(r.service_family, r.months_since_start): r.active_logos for r in sub.retention(spark.createDataFrame(rows, PAID)).collect()}
    assert got == {("X", 0): 2, ("X", 1): 1, ("X", 2): 1}


def lines(spark, revenues):
    rows = [
        (dt.date(2024, 1, 5), i, c, "C2 Backup", "C2-BACKUP-1T-BASIC", "W", "n", Decimal(2), Decimal(r))
        for i, (c, r) in enumerate(revenues)
    ]
    return spark.createDataFrame(
        rows, "inv_date date, order_id long, customer string, product string, code string, region string,"
        " country string, quantity decimal(12,2), usd_total decimal(21,7)",
    )


def test_equal_revenue_shares_a_tier(spark):
    # 6 customers on each of 25 revenue levels: dense ranks 1 to 25.
    revenues = [(f"c{level}_{i}", 100 - level) for level in range(25) for i in range(6)]
    subs = sub.subscription_lines(lines(spark, revenues))
    tiers = {r.customer: r.customer_tier for r in sub.customer_tiers(subs).collect()}
    for level in range(25):
        want = fixed.TIER_1 if level < 5 else fixed.TIER_2 if level < 20 else fixed.TIER_3
        assert all(tiers[f"c{level}_{i}"] == want for i in range(6))
    ordinal = [r.customer_tier for r in sub.customer_tiers_ordinal(subs).collect()]
    assert [ordinal.count(t) for t in (fixed.TIER_1, fixed.TIER_2, fixed.TIER_3)] == [5, 15, 130]
    joined = {r.customer: r.customer_tier for r in sub.with_tier(subs).select("customer", "customer_tier").collect()}
    assert joined == tiers


def test_few_customers_are_all_leading(spark):
    subs = sub.subscription_lines(lines(spark, [("a", 5), (None, 4)]))
    tiers = {r.customer: r.customer_tier for r in sub.customer_tiers(subs).collect()}
    assert tiers == {"a": fixed.TIER_1, "": fixed.TIER_1}


def test_scorecard(spark):
    subs = sub.subscription_lines(lines(spark, [("a", 5), ("a", 7), ("b", 1)]))
    row = sub.adoption_scorecard(subs).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.service_family, r.plan_variant, r.active_subscriptions, r.new_subscriptions) == ("BACKUP", "BASIC", 2, 3)
    assert (r.mrr_usd, r.total_quantity, r.avg_seats) == (13.0, 6.0, 3.0)
    total = sub.subscription_totals(subs).collect()[0]
    assert (total.mrr_total, total.arr_total, total.active_subs_total) == (13.0, 156.0, 2)


def test_cohort_filter_takes_prefix_or_word(spark):
    df = lines(spark, [("a", 1)]).drop("product", "code")
    from pyspark.sql import functions as F

    for product, code, kept in [("x", "c2-a", 1), ("my C2 plan", "z", 1), ("Active Insight", "", 1), ("C21", "z", 0), (None, None, 0)]:
        row = df.withColumns({"product": F.lit(product).cast("string"), "code": F.lit(code).cast("string")})
        assert sub.subscription_lines(row).count() == kept, product


def test_scorecard_scans_the_lines_once(spark, tmp_path):
    """The lines are gone once the grain is written; dashboards read the stored card."""
    rows = lines(spark, [("a", 5), ("a", 7), ("b", 1), (None, 2)])
    rows.write.parquet(str(tmp_path / "lines"))
    subs = sub.subscription_lines(spark.read.parquet(str(tmp_path / "lines")))
    card = sub.adoption_scorecard(subs)
    text = card._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in text and text.count("Relation [") <= 4
    for part in (tmp_path / "lines").glob("part-*"):
        part.unlink()
    assert [r.active_subscriptions for r in card.collect()] == [3]


def test_dashboards_share_one_card(spark):
    from ledgerline.plans import subscription as plans

    first, second = (plans.stored_card(spark, SF) for _ in range(2))
    assert first is second and "lineitem" not in " ".join(first.inputFiles())
