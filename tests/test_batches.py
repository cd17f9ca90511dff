"""Sinks and state of repeated micro-batches: broken off at any write, restarted, compacted."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException

from fixtures import basic
from orderlens.functions.cleaning import clean
from orderlens.operators import marts
from orderlens.operators.enrich import enrich
from orderlens.plans.facts import facts_from_raw, facts_from_tables
from orderlens.plans.stream_job import _interrupt_once, _until_done
from orderlens.streaming import decode, publish, read_stream
from orderlens.streaming.batches import compact, kpi_from_state, partial_state, read_sink, read_state, revenue_from_state, run_sinks, run_state


@pytest.mark.parametrize("kind", ["rows", "rejects"])
def test_both_sinks_survive_a_break_between_them(spark, tmp_path, kind):
    landing = tmp_path / "in"
    landing.mkdir()
    for k in range(3):
        (landing / f"{k}.txt").write_text("\n".join([json.dumps({"order_id": f"o{k}"}), f"broken {k}", "[]"]) + "\n")
    stream = read_stream(spark, fmt="text", path=str(landing), max_per_trigger=1)
    hook = _interrupt_once(kind, 1)
    rows, bad, chk = (str(tmp_path / n) for n in ("rows", "bad", "chk"))
    with pytest.raises(StreamingQueryException):
        run_sinks(stream, rows, bad, chk, on_written=hook).awaitTermination()
    run_sinks(stream, rows, bad, chk, on_written=hook).awaitTermination()
    assert sorted(r.order_id for r in read_sink(spark, rows).collect()) == ["o0", "o1", "o2"]
    assert sorted(r.value for r in read_sink(spark, bad).collect()) == ["[]", "[]", "[]", "broken 0", "broken 1", "broken 2"]


def test_state_equals_the_batch_result_through_breaks_and_versions(spark, tmp_path):
    whole = clean(enrich(basic(spark)))
    landing, state, chk = (str(tmp_path / n) for n in ("in", "state", "chk"))
    publish(whole.repartition(3), fmt="text", path=landing)
    stream = read_stream(spark, fmt="text", path=landing, max_per_trigger=1)
    hook = _interrupt_once("state", 1)

    def start():
        return run_state(stream, state, chk, on_written=hook)

    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    assert compact(spark, state) == 1  # holds a batch that is not committed yet
    assert compact(spark, state) == 1
    _until_done(start)
    f = facts_from_tables(basic(spark))
    for merged in (read_state(spark, state), read_state(spark, state) if compact(spark, state) else None):
        assert kpi_from_state(merged).collect() == marts.kpi_summary(f).collect()
        assert revenue_from_state(merged).collect() == marts.revenue_by_state(f).collect()
    # a version without its marker is not read
    read_state(spark, state).limit(0).write.mode("overwrite").parquet(f"{state}/versions/version=99")
    assert kpi_from_state(read_state(spark, state)).collect() == marts.kpi_summary(f).collect()


def test_an_order_in_two_batches_counts_once(spark):
    lines = [json.dumps({"order_id": "o", "customer_state": s, "price": 1.5}) for s in ("SP", "SP", "RJ")]
    parts = [partial_state(facts_from_raw(decode(spark.createDataFrame([(x,)], "value string")))) for x in lines]
    state = parts[0].unionByName(parts[1]).unionByName(parts[2])
    kpi = kpi_from_state(state).first()
    assert (kpi.total_orders, kpi.total_revenue) == (1, 4.5)


def test_kpi_of_the_state_shuffles_once_and_the_state_is_zstd(spark, tmp_path):
    """The merge and the orders share one shuffle by the order; rows of an order in several batches, states and versions add up."""
    landing, path, chk = (str(tmp_path / n) for n in ("in", "state", "chk"))
    rows = [("o1", "SP", 1.5), ("o1", "SP", 1.5), ("o1", "RJ", 1.5), (None, "SP", 1.0), (None, "RJ", 1.0), ("o2", None, 0.5)]
    (tmp_path / "in").mkdir()
    for k, (order, state, price) in enumerate(rows):
        message = {"order_id": order, "customer_state": state, "price": price}
        (tmp_path / "in" / f"{k}.txt").write_text(json.dumps({n: v for n, v in message.items() if v is not None}) + "\n")
    run_state(read_stream(spark, fmt="text", path=landing, max_per_trigger=2), path, chk).awaitTermination()
    for compacted in (False, True):
        if compacted:
            compact(spark, path)
            (tmp_path / "in" / "6.txt").write_text(json.dumps({"order_id": "o2", "price": 2.0}) + "\n")
            run_state(read_stream(spark, fmt="text", path=landing), path, chk).awaitTermination()
        kpi = kpi_from_state(read_state(spark, path))
        assert (kpi.first().total_orders, kpi.first().total_revenue) == (2, 9.0 if compacted else 7.0)
        plan = kpi._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    assert read_state(spark, path).count() == 5
    files = [p for p in (tmp_path / "state").rglob("part-*.parquet") if "complete" not in str(p)]
    assert files and all(".zstd." in p.name for p in files)
