"""The factorised aggregates equal the same outputs over the joined rows, odd rows included."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from fixtures import tables
from orderlens.operators import factorised, marts, orders
from orderlens.plans.facts import facts_from_tables
from orderlens.plans.refresh import all_outputs, grain_outputs
from orderlens.sources.testdata import load_testdata
from sf_dirs import SF_SMALL

KEYS = ["customer_state", "customer_city", "product_category_name", "product_id", "seller_id", "payment_type"]


def odd(spark):
    """Null and blank ids, unknown parents, amounts that are none, empty sides, repeated rows."""
    when = dict(order_purchase_timestamp="2018-01-02 09:00:00", order_estimated_delivery_date="2018-01-05 00:00:00")
    return tables(
        spark,
        orders=[
            dict(order_id="a", customer_id="c1", order_status="delivered", order_delivered_customer_date="2018-01-09 00:00:00", **when),
            dict(order_id="b", customer_id="c1", order_status="delivered", order_delivered_customer_date="2018-01-03 00:00:00", **when),
            dict(order_id="c", customer_id="nobody", order_status=None),
            dict(order_id="d", customer_id=None, order_status="canceled", **when),
            dict(order_id=None, customer_id="c2", order_status="lost", **when),
            dict(order_id=None, customer_id=None),
            dict(order_id="", customer_id="c2", order_status="blank", **when),
            dict(order_id="e", customer_id="c2", order_status="delivered", **when),
            dict(order_id="e", customer_id="c1", order_status="delivered", order_delivered_customer_date="2018-02-09 00:00:00"),
        ],
        items=[
            dict(order_id="a", order_item_id="1", product_id="p1", seller_id="s1", price="10.5", freight_value="1.25"),
            dict(order_id="a", order_item_id="1", product_id="p1", seller_id="s1", price="10.5", freight_value="1.25"),
            dict(order_id="a", order_item_id="2", product_id="p2", seller_id=None, price="1e20", freight_value="3"),
            dict(order_id="a", order_item_id="3", product_id=None, seller_id="", price="NaN", freight_value=None),
            dict(order_id="b", order_item_id="1", product_id="gone", seller_id="s2", price="1e30", freight_value="2"),
            dict(order_id="e", order_item_id="1", product_id="p2", seller_id="s2", price="7.77", freight_value="0.33"),
            dict(order_id="zz", order_item_id="1", product_id="p1", seller_id="s1", price="1000", freight_value="1"),
            dict(order_id=None, order_item_id="1", product_id="p1", seller_id="s1", price="1000", freight_value="1"),
            dict(order_id="", order_item_id="1", product_id="", seller_id="s1", price="5", freight_value="1"),
        ],
        products=[dict(product_id="p1", product_category_name="toys"), dict(product_id="p2"), dict(product_id="p3", product_category_name="never")],
        customers=[dict(customer_id="c1", customer_city="x", customer_state="SP"), dict(customer_id="c2", customer_state="")],
        payments=[
            dict(order_id="a", payment_sequential="1", payment_type="card", payment_installments="2", payment_value="12"),
            dict(order_id="a", payment_sequential="2", payment_type="card", payment_installments="1", payment_value="1e20"),
            dict(order_id="a", payment_sequential="3", payment_type=None, payment_installments=None, payment_value="3.333"),
            dict(order_id="e", payment_sequential="1", payment_type="slip", payment_installments="1", payment_value="5"),
            dict(order_id="d", payment_sequential="1", payment_type="", payment_installments="x", payment_value=None),
            dict(order_id=None, payment_type="ghost", payment_value="9"),
            dict(order_id="zz", payment_type="ghost", payment_value="9"),
            dict(order_id="", payment_type="blank", payment_value="9"),
        ],
        reviews=[
            dict(order_id="a", review_id="r1", review_score="5", review_answer_timestamp="2018-01-15 00:00:00"),
            dict(order_id="a", review_id="r2", review_score="1", review_answer_timestamp="2018-01-15 00:00:00"),
            dict(order_id="c", review_id="r3", review_score=None),
            dict(order_id="e", review_id="r4", review_score="3.5", review_answer_timestamp="2018-01-16 00:00:00"),
            dict(order_id="zz", review_id="r5", review_score="2"),
        ],
    )


CASES = {"odd": odd, "empty": lambda spark: tables(spark), "testdata": lambda spark: load_testdata(spark, SF_SMALL)}


def rows(df):
    return sorted((str(tuple(r)) for r in df.collect()))


@pytest.fixture(scope="module", params=sorted(CASES))
def case(request, spark):
    t = CASES[request.param](spark)
    f = facts_from_tables(t).cache()
    yield t, f
    f.unpersist()


def test_revenue_by_every_dimension(case):
    t, f = case
    for key in KEYS:
        assert rows(factorised.revenue_by(t, key)) == rows(marts.revenue_by(f, key)), key


def test_decision_support(case):
    t, f = case
    assert rows(marts.decision_support(None, sets=factorised.decision_sets(t))) == rows(marts.decision_support(f))


def test_all_outputs_and_the_order_frame(case):
    t, f = case
    grain = factorised.order_grain(t, buckets=4)
    got, _ = grain_outputs(grain, shared=False)
    want, _ = all_outputs(f, shared=False)
    assert set(got) == set(want)
    for name, df in want.items():
        assert got[name].columns == df.columns, name
        assert rows(got[name]) == rows(df), name
    level = factorised.order_level(grain)
    plain = orders.order_level(f, [c for c in level.columns if c not in ("order_id", "order_revenue_exact")])
    assert rows(level.select(sorted(level.columns))) == rows(plain.select(sorted(level.columns)))
    grain.drop()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_no_row_of_one_side_meets_another(spark):
    """Joins pair a side with the orders only: payments and reviews are aggregated by order below them."""
    t = load_testdata(spark, SF_SMALL)
    text = plan(factorised.revenue_by(t, "product_id"))
    assert text.split("\n\n")[0].count("Join") == 1
    skewed = tables(
        spark,
        orders=[dict(order_id="o", customer_id="c")],
        items=[dict(order_id="o", product_id=f"p{i}", seller_id="s", price="1", freight_value="0") for i in range(40)],
        payments=[dict(order_id="o", payment_type=f"t{i % 3}", payment_value="1") for i in range(50)],
        reviews=[dict(order_id="o", review_id=str(i), review_score="4") for i in range(60)],
        customers=[dict(customer_id="c", customer_state="SP")],
    )
    for key in KEYS:
        assert factorised.revenue_by(skewed, key).agg(F.sum("revenue_exact")).first()[0] == 40 * 50 * 60
    assert factorised.lines(skewed).count() == 40


def test_the_order_outputs_exchange_no_orders(spark):
    grain = factorised.order_grain(load_testdata(spark, SF_SMALL), buckets=4)
    got, _ = grain_outputs(grain, shared=False)
    names = ["kpi_summary", "kpi_summary_order_level", "orders_per_day", "order_status_breakdown", "orders_by_state", "avg_order_value_by_state", "late_delivery_by_state"]
    for name, df in [*((n, got[n]) for n in names), ("order_level", factorised.order_level(grain))]:
        text = plan(df)
        assert not [line for line in text.splitlines() if "hashpartitioning" in line and "order_id" in line], name
        assert text.split("\n\n")[0].count("Scan parquet") == 1, name
    grain.drop()
