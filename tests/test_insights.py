"""Insight blocks on hand-written and empty inputs."""

from __future__ import annotations

import pytest

from fixtures import basic, tables
from orderlens.operators import insights
from orderlens.plans.facts import facts_from_tables


@pytest.fixture(scope="module")
def f(spark):
    return facts_from_tables(basic(spark))


def test_every_block_is_one_row_on_empty_input(spark):
    empty = facts_from_tables(tables(spark))
    for name, fn in insights.BLOCKS.items():
        rows = fn(empty).collect()
        assert len(rows) == 1, name


def test_shares_and_leaders(f):
    st = insights.order_status(f).first()
    assert st.total_orders == 2 and st.delivered_share == 0.5 and st.canceled_share == 0.5
    rs = insights.revenue_by_state(f).first()
    assert rs.top_state == "SP" and rs.top_share == 1.0 and rs.concentration_index == 1.0
    pay = insights.payment_orders(f).first()
    assert (pay.credit_card_orders, pay.boleto_orders, pay.total_orders) == (1, 0, 3)
    assert pay.other_share == pytest.approx(2 / 3)
    ot = insights.on_time_vs_late(f).first()
    assert ot.late_share == 0.8 and ot.on_time_share == 0.2


def test_installments_mode_ties_take_smallest(spark):
    t = tables(
        spark,
        orders=[dict(order_id="o1", customer_id="c"), dict(order_id="o2", customer_id="c")],
        payments=[dict(order_id="o1", payment_installments="3"), dict(order_id="o2", payment_installments="2")],
    )
    m = insights.installments(facts_from_tables(t)).first()
    assert m.mode_installments == 2 and m.mode_share == 0.5 and m.multi_installment_share == 1.0


def test_best_and_worst_by_score(spark):
    t = tables(
        spark,
        orders=[dict(order_id=f"o{i}", customer_id=f"c{i}") for i in range(3)],
        customers=[dict(customer_id=f"c{i}", customer_state=s) for i, s in enumerate(["A", "B", "C"])],
        reviews=[dict(order_id=f"o{i}", review_id=f"r{i}", review_score=s) for i, s in enumerate(["5", "1", "5"])],
    )
    r = insights.review_score_by_state(facts_from_tables(t)).first()
    assert (r.best_state, r.best_score, r.worst_state, r.worst_score) == ("A", 5.0, "B", 1.0)
    assert r.score_gap == 4.0 and r.mean_score == pytest.approx(11 / 3)
