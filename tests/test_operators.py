"""Hand-written cases for cleaning, derivation, joins and aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fixtures import basic, tables
from orderlens import schema as S
from orderlens.functions.cleaning import clean
from orderlens.functions.derive import derive
from orderlens.operators import marts, orders
from orderlens.operators.enrich import enrich
from orderlens.plans.facts import facts_from_tables


def test_fan_out_grain(spark):
    f = facts_from_tables(basic(spark))
    o1 = f.where("order_id = 'o1'")
    assert o1.count() == 4  # 2 items x 2 payments x 1 review
    kpi = marts.kpi_summary(f).first()
    # each item counted twice: 2 * (110.15 + 55)
    assert kpi.total_revenue == 330.30
    assert kpi.total_orders == 2


def test_order_without_items_payment_review(spark):
    row = facts_from_tables(basic(spark)).where("order_id = 'o2'").first()
    assert row.revenue == 0.0 and row.price == 0.0
    assert row.product_category_name == "unknown" and row.seller_id == "unknown" and row.product_id == "unknown"
    assert row.payment_type == "unknown" and row.payment_value is None
    assert row.review_sentiment == "unknown"
    assert row.delivery_delay_days == 0 and row.is_late_delivery == 0


def test_enriched_schema_and_typing(spark):
    e = clean(enrich(basic(spark)))
    assert e.columns == S.ENRICHED_COLUMNS
    types = {f.name: f.dataType.simpleString() for f in e.schema.fields}
    assert types["order_purchase_timestamp"] == "timestamp"
    assert types["price"] == "double"
    assert types["customer_zip_code_prefix"] == "int"
    zips = {r.customer_id: r.customer_zip_code_prefix for r in e.select("customer_id", "customer_zip_code_prefix").collect()}
    assert zips == {"c1": 14409, "c2": 1001}


def test_sentiment_buckets(spark):
    scores = ["1", "2", "3", "3.5", "4", "5", "0", None]
    t = tables(
        spark,
        orders=[dict(order_id=f"o{i}", customer_id="c") for i in range(len(scores))],
        reviews=[dict(order_id=f"o{i}", review_id=f"r{i}", review_score=s) for i, s in enumerate(scores)],
    )
    got = {r.order_id: r.review_sentiment for r in facts_from_tables(t).collect()}
    want = ["negative", "negative", "neutral", "negative", "positive", "positive", "unknown", "unknown"]
    assert [got[f"o{i}"] for i in range(len(scores))] == want


def test_delivery_delay_rules(spark):
    cases = [
        (None, "2018-01-10 00:00:00", 0, 0),
        ("2018-01-10 18:00:00", "2018-01-10 00:00:00", 0, 0),
        ("2018-01-11 01:00:00", "2018-01-10 00:00:00", 1, 1),
        ("2018-01-05 00:00:00", "2018-01-10 00:00:00", -5, 0),
    ]
    t = tables(
        spark,
        orders=[
            dict(order_id=f"o{i}", customer_id="c", order_delivered_customer_date=d, order_estimated_delivery_date=e)
            for i, (d, e, _, _) in enumerate(cases)
        ],
    )
    got = {r.order_id: (r.delivery_delay_days, r.is_late_delivery) for r in facts_from_tables(t).collect()}
    for i, (_, _, delay, late) in enumerate(cases):
        assert got[f"o{i}"] == (delay, late)


def test_malformed_values_become_null(spark):
    t = tables(
        spark,
        orders=[dict(order_id="o1", customer_id="c", order_purchase_timestamp="n/a")],
        items=[dict(order_id="o1", order_item_id="x", price="abc", freight_value="NaN")],
    )
    row = facts_from_tables(t).first()  # no exception under ANSI
    assert row.order_purchase_timestamp is None and row.purchase_date is None
    assert row.order_item_id is None
    assert row.price == 0.0 and row.freight_value == 0.0  # null -> 0 before revenue


def test_missing_columns_are_typed_nulls(spark):
    df = spark.createDataFrame([("o1", "c1")], "order_id string, customer_id string")
    f = derive(clean(df))
    row = f.first()
    assert row.revenue == 0.0 and row.review_sentiment == "unknown" and row.delivery_delay_days == 0
    assert row.customer_state == "unknown"


def test_empty_input_kpi_zeros(spark):
    f = facts_from_tables(tables(spark))
    assert f.count() == 0
    kpi = marts.kpi_summary(f).collect()
    assert len(kpi) == 1
    assert tuple(kpi[0]) == (0.0, 0, 0.0, 0.0, 0.0)
    assert tuple(orders.kpi_summary_order_level(f).first()) == (0.0, 0, 0.0, 0.0, 0.0)
    assert marts.average_payment_value(f).first()[0] == 0.0
    assert marts.revenue_by_state(f).count() == 0
    ds = marts.decision_support(f).first()
    assert ds.best_state_by_revenue is None and ds.positive_review_ratio == 0.0


def test_top_k_tie_breaks_on_key(spark):
    rows = [dict(order_id=f"o{i}", customer_id="c") for i in range(12)]
    items = [dict(order_id=f"o{i}", order_item_id="1", product_id="p", seller_id=f"s{i:02d}", price="10")
             for i in range(12)]
    t = tables(spark, orders=rows, items=items)
    top = [r.seller_id for r in marts.top_sellers(facts_from_tables(t)).collect()]
    assert top == [f"s{i:02d}" for i in range(10)]


def test_representative_row_prefers_non_null_answer(spark):
    t = tables(
        spark,
        orders=[dict(order_id="o1", customer_id="c", order_purchase_timestamp="2018-01-01 00:00:00")],
        reviews=[
            dict(order_id="o1", review_id="ra", review_score="1"),
            dict(order_id="o1", review_id="rb", review_score="5", review_answer_timestamp="2018-02-01 00:00:00"),
        ],
    )
    ol = orders.order_level(facts_from_tables(t)).first()
    assert ol.review_id == "rb" and ol.review_score == 5.0


def test_order_level_kpi_differs_only_in_review_and_late(spark):
    f = facts_from_tables(basic(spark))
    a = marts.kpi_summary(f).first()
    b = orders.kpi_summary_order_level(f).first()
    assert a.total_revenue == b.total_revenue and a.total_orders == b.total_orders
    assert b.avg_review_score == 5.0 and b.late_delivery_rate == 0.5


def test_published_sort_orders(spark):
    f = facts_from_tables(basic(spark))
    inst = [r.payment_installments for r in marts.installments_distribution(f).collect()]
    assert inst == [1.0, 3.0, None]  # null group last
    scores = [r.review_score for r in marts.review_score_distribution(f).collect()]
    assert scores == [5.0, None]
    states = [r.customer_state for r in marts.revenue_by_state(f).collect()]
    assert states == ["SP", "RJ"]


def test_exact_rounding_half_away_from_zero(spark):
    from orderlens.functions.money import round_div

    df = spark.createDataFrame([(1113350, 2000, 0), (-1113350, 2000, 0), (1, 3, 0), (2, 3, 0), (5, 1000, 0)],
                               "n long, d long, s int")
    got = [r[0] for r in df.select(round_div(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [556.68, -556.68, 0.33, 0.67, 0.01]


def test_date_type_of_purchase_date(spark):
    f = facts_from_tables(basic(spark))
    assert f.where("order_id = 'o1'").first().purchase_date == dt.date(2018, 1, 1)
