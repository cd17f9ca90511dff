"""Physical-plan guardrails: the scale properties the design relies on."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from sf_dirs import SF_SMALL
from orderlens.plans.catalog import queries

RUNS_JOBS = {
    "stream_ingest_roundtrip", "snapshot_csv_roundtrip", "landing_csv_roundtrip", "contract_report", "export_reload",
    "awkward_text_roundtrip", "ingest_rejects", "contract_summary", "manifest_report", "reload_rejects", "snapshot_orders_in_range", "snapshot_date_bounds",
    "stream_state_kpi", "stream_state_revenue", "translated_categories",
}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def tree(text: str) -> str:
    return text.split("\n\n")[0]


@pytest.mark.parametrize("name", sorted(set(queries()) - RUNS_JOBS))
def test_no_pairwise_joins(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


# What each scan must read, by the source columns the output is made of.
READ = {
    "revenue_by_state": [
        {"o_orderkey"}, {"o_orderkey", "o_custkey"}, {"c_custkey", "c_nationkey"}, {"n_nationkey", "n_name"}, {"l_orderkey", "l_extendedprice", "l_tax"},
    ],
    "top_products": [{"o_orderkey"}, {"l_orderkey"}, {"l_orderkey", "l_partkey", "l_extendedprice", "l_tax"}],
    "revenue_by_category": [{"o_orderkey"}, {"l_orderkey"}, {"l_orderkey", "l_partkey", "l_extendedprice", "l_tax"}, {"p_partkey", "p_brand", "p_size"}],
    "revenue_by_payment_type": [{"o_orderkey"}, {"o_orderkey", "o_orderpriority"}, {"l_orderkey", "l_extendedprice", "l_tax"}],
    # over the joined rows: the keys of the joins and what the output shows
    "orders_per_day": [{"o_orderkey", "o_custkey", "o_orderdate"}, {"o_orderkey"}, {"c_custkey", "c_nationkey"}, {"n_nationkey"}, {"l_orderkey", "l_partkey"}, {"p_partkey"}],
}


@pytest.mark.parametrize("name", sorted(READ))
def test_scans_read_what_the_output_needs(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    scans = [{c.split(":")[0] for c in s.split(",")} for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    # the adapter makes payments and reviews from rows of orders, by arrays that are read whole
    allowed = [*READ[name], {"o_orderkey", "o_orderpriority", "o_totalprice"}, {"o_orderkey", "o_orderdate"}]
    assert scans
    for scan in scans:
        assert any(scan <= a for a in allowed), scan


def test_decision_support_collapses_orders_before_it_expands(spark):
    t = tree(plan(E.queries()["decision_support"](spark, SF_SMALL)))
    assert "Expand" not in t and t.count("Generate") >= 1
    # below the generated rows: one row an order, from aggregations by order
    assert t.index("Generate") < t.index("collect_list") if "collect_list" in t else t.index("Generate") < t.index("Join")


def test_order_level_aggregates_on_the_join_output(spark):
    t = tree(plan(E.queries()["order_level"](spark, SF_SMALL)))
    top = t.split("SortMergeJoin")[0]
    assert "SortAggregate" in top and "Exchange" not in top and "Sort " not in top.replace("SortAggregate", "")


def test_distinct_counts_need_no_extra_shuffle_of_rows(spark):
    t = tree(plan(E.queries()["late_delivery_by_state"](spark, SF_SMALL)))
    above_join = t.split("SortMergeJoin")[0]
    # (state, order_id) partial aggregation sits on the join; only per-state rows are exchanged after it
    assert above_join.count("Exchange") == 2  # group by state, final range sort of the output
