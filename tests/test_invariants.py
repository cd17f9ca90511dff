"""Cross-table invariants of the published outputs."""

from __future__ import annotations

import pytest

from sf_dirs import SF_SMALL
from orderlens.operators import marts, orders
from orderlens.plans.facts import facts


@pytest.fixture(scope="module")
def f(spark):
    cached = facts(spark, SF_SMALL).cache()
    yield cached
    cached.unpersist()  # the cache manager matches plans; do not leak into later plan tests


def total(df, col):
    return sum(r[col] for r in df.collect())


def test_row_totals_agree(f):
    n = f.count()
    assert total(marts.installments_distribution(f), "count") == n
    assert total(marts.review_distribution(f), "count") == n
    assert total(marts.review_score_distribution(f), "count") == n
    assert total(marts.on_time_vs_late_delivery(f), "count") == n
    assert total(marts.late_delivery_by_state(f), "total_rows") == n


def test_order_totals_agree(f):
    kpi = marts.kpi_summary(f).first()
    assert total(marts.orders_by_state(f), "order_count") == kpi.total_orders
    assert total(marts.order_status_breakdown(f), "order_count") == kpi.total_orders
    assert total(marts.orders_per_day(f), "order_count") == kpi.total_orders
    assert total(marts.orders_by_payment_type(f), "order_count") >= kpi.total_orders
    assert orders.kpi_summary_order_level(f).first().total_orders == kpi.total_orders


def test_revenue_totals_agree(f):
    kpi = marts.kpi_summary(f).first()
    for t in (marts.revenue_by_state(f), marts.revenue_by_category(f), marts.revenue_by_payment_type(f)):
        rows = t.collect()
        assert abs(sum(r.revenue for r in rows) - kpi.total_revenue) <= 0.005 * len(rows) + 1e-6
    assert orders.kpi_summary_order_level(f).first().total_revenue == kpi.total_revenue


def test_late_totals_agree(f):
    late = {r.delivery_status: r["count"] for r in marts.on_time_vs_late_delivery(f).collect()}
    assert late.get("late", 0) == total(marts.late_delivery_by_state(f), "late_rows")


def test_decision_support_matches_leaders(f):
    ds = marts.decision_support(f).first()
    assert ds.best_state_by_revenue == marts.revenue_by_state(f).first().customer_state
    assert ds.top_category_by_revenue == marts.revenue_by_category(f).first().product_category_name
    assert ds.top_payment_type == marts.orders_by_payment_type(f).first().payment_type
    assert ds.worst_state_by_late_rate == marts.late_delivery_by_state(f).first().customer_state


def test_order_value_at_least_row_average(f):
    from pyspark.sql import functions as F

    aov = {r.customer_state: r.avg_order_value for r in marts.avg_order_value_by_state(f).collect()}
    per_row = {r.customer_state: r.a for r in f.groupBy("customer_state").agg(F.avg("revenue").alias("a")).collect()}
    assert aov.keys() == per_row.keys()
    assert all(aov[s] + 0.005 >= per_row[s] for s in aov)
