"""Codec cases, stream == batch, restart without duplicates."""

from __future__ import annotations

import json
import os

from sf_dirs import SF_SMALL
from fixtures import basic
from orderlens.operators import marts
from orderlens.plans.facts import enriched, facts, facts_from_raw
from orderlens.sources import read_snapshot
from orderlens.streaming import decode, encode, publish, read_stream, rejects, run_append


def test_decode_nan_missing_and_extra_keys(spark):
    lines = [
        '{"order_id": "o1", "customer_id": "c1", "price": NaN, "payment_type": NaN, "extra": 1}',
        '{"order_id": "o2", "customer_id": "c2", "price": 12.5, "review_score": "NaN"}',
    ]
    raw = decode(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert "extra" not in raw.columns
    got = {r.order_id: r for r in facts_from_raw(raw).collect()}
    assert got["o1"].price == 0.0 and got["o1"].payment_type == "unknown"
    assert got["o1"].review_score is None and got["o1"].customer_state == "unknown"
    assert got["o2"].price == 12.5 and got["o2"].review_score is None


def test_encode_roundtrip_keeps_values(spark):
    e = enriched(spark, SF_SMALL)
    back = facts_from_raw(decode(encode(e)))
    a = marts.late_delivery_by_state(facts(spark, SF_SMALL)).collect()
    b = marts.late_delivery_by_state(back).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    keys = encode(e).select("key").limit(1).first().key
    assert isinstance(keys, str)


def test_stream_equals_batch_and_restart_is_idempotent(spark, tmp_path):
    landing, sink, chk = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "chk")
    publish(enriched(spark, SF_SMALL), fmt="text", path=landing)
    run_append(read_stream(spark, fmt="text", path=landing), sink, chk).awaitTermination()
    first = spark.read.parquet(sink).count()
    assert first == enriched(spark, SF_SMALL).count()

    batch = marts.revenue_by_state(facts(spark, SF_SMALL)).collect()
    streamed = marts.revenue_by_state(facts_from_raw(spark.read.parquet(sink))).collect()
    assert [tuple(r) for r in batch] == [tuple(r) for r in streamed]

    # same checkpoint, no new input: nothing is appended again
    run_append(read_stream(spark, fmt="text", path=landing), sink, chk).awaitTermination()
    assert spark.read.parquet(sink).count() == first

    # one new message file: only its rows are appended
    with open(os.path.join(landing, "extra.txt"), "w") as fh:
        fh.write(json.dumps({"order_id": "new-1", "customer_id": "c", "price": 1.5}) + "\n")
    run_append(read_stream(spark, fmt="text", path=landing), sink, chk).awaitTermination()
    assert spark.read.parquet(sink).count() == first + 1


def test_hand_written_tables_stream(spark, tmp_path):
    landing = str(tmp_path / "in")
    publish(enriched_basic(spark), fmt="text", path=landing)
    run_append(read_stream(spark, fmt="text", path=landing), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    kpi = marts.kpi_summary(facts_from_raw(spark.read.parquet(str(tmp_path / "o")))).first()
    assert kpi.total_revenue == 330.30 and kpi.total_orders == 2


def enriched_basic(spark):
    from orderlens.functions.cleaning import clean
    from orderlens.operators.enrich import enrich

    return clean(enrich(basic(spark)))


def test_bounded_micro_batches(spark, tmp_path):
    landing, sink, chk = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "chk")
    publish(enriched(spark, SF_SMALL).repartition(4), fmt="text", path=landing)
    q = run_append(read_stream(spark, fmt="text", path=landing, max_per_trigger=1), sink, chk)
    q.awaitTermination()
    assert len(q.recentProgress) >= 4  # one file per committed batch
    assert spark.read.parquet(sink).count() == enriched(spark, SF_SMALL).count()


def test_malformed_messages_are_rejected(spark, tmp_path):
    whole = json.dumps({"order_id": "o1", "customer_id": "c", "price": 1.5})
    lines = [whole, whole[:-1], "not json", "[1, 2]", "", "null", json.dumps({"order_id": "o2"})]
    messages = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r.order_id for r in decode(messages).collect()) == ["o1", "o2"]
    assert sorted(r.value for r in rejects(messages).collect()) == sorted(lines[1:6])


def test_awkward_text_through_the_csv_sink(spark, tmp_path):
    texts = ['say "late",\nreally', " SP ", "tab\t, comma", "\\", 'end"', "line1\nline2"]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "order_id string, review_comment_message string")
    publish(rows, fmt="text", path=str(tmp_path / "in"))
    publish(rows, fmt="text", path=str(tmp_path / "in"))  # publishing again replaces
    stream = read_stream(spark, fmt="text", path=str(tmp_path / "in"))
    run_append(stream, str(tmp_path / "out"), str(tmp_path / "chk"), fmt="csv").awaitTermination()
    back = read_snapshot(spark, str(tmp_path / "out"))
    assert {r.order_id: r.review_comment_message for r in back.collect()} == {str(i): t for i, t in enumerate(texts)}
