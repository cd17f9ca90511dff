"""S9/S10 export and reload, Q1-Q5 contract checks."""

from __future__ import annotations

from sf_dirs import SF_SMALL
from orderlens import schema as S
from orderlens.operators import contracts
from orderlens.plans.refresh import all_outputs, refresh
from orderlens.plans.facts import facts
from orderlens.sources.csv_format import read_options
from orderlens.sources.sinks import export_table, export_tables, read_table
from orderlens.sources.testdata import load_testdata


def test_csv_roundtrip_of_awkward_text(spark, tmp_path):
    text = 'line one\nline "two", with comma'
    df = spark.createDataFrame([("r1", text)], "review_id string, review_comment_message string")
    export_table(df, str(tmp_path / "t"))
    back = spark.read.options(**read_options()).csv(str(tmp_path / "t")).first()
    assert back.review_comment_message == text


def test_export_reload_and_report(spark, tmp_path):
    out = str(tmp_path / "agg")
    outputs = refresh(spark, load_testdata(spark, SF_SMALL), out_dir=out)
    assert not outputs._cached  # released after the export
    report = {r.table: r for r in contracts.contract_report(spark, out).collect()}
    assert set(report) == set(S.EXPECTED_OUTPUTS)
    assert all(r.status == "ok" and r.exists for r in report.values())
    assert report["kpi_summary"].row_count == 1
    assert report["revenue_by_state"].row_count == outputs["revenue_by_state"].count()
    summary = contracts.contract_summary(contracts.contract_report(spark, out)).first()
    assert summary.status == "ok" and summary.missing_tables == [] and summary.last_modified is not None

    for name in S.EXPECTED_OUTPUTS:  # S9 -> S10 round trip keeps types and values
        back = read_table(spark, out, name)
        assert back.schema == S.OUTPUT_SCHEMAS[name], name
        assert sorted(map(repr, back.collect())) == sorted(map(repr, outputs[name].collect())), name
    cols = {r.table: r.columns_ok for r in contracts.column_check(spark, out).collect()}
    assert all(cols.values())


def test_missing_and_empty_tables(spark, tmp_path):
    out = str(tmp_path / "partial")
    f = facts(spark, SF_SMALL)
    outputs, _ = all_outputs(f, shared=False)
    keep = {k: v for k, v in outputs.items() if k not in ("top_sellers", "orders_per_day")}
    keep["orders_per_day"] = outputs["orders_per_day"].limit(0)
    export_tables(keep, out)
    report = {r.table: r.status for r in contracts.contract_report(spark, out).collect()}
    assert report["top_sellers"] == "error" and report["orders_per_day"] == "warning"
    summary = contracts.contract_summary(contracts.contract_report(spark, out)).first()
    assert summary.status == "error" and summary.missing_tables == ["top_sellers"]
    assert summary.empty_tables == ["orders_per_day"]
    missing = read_table(spark, out, "top_sellers")
    assert missing.count() == 0 and missing.schema == S.OUTPUT_SCHEMAS["top_sellers"]


def test_shared_and_independent_plans_agree(spark):
    f = facts(spark, SF_SMALL)
    shared, cached = all_outputs(f, shared=True)
    alone, _ = all_outputs(f, shared=False)
    for name in shared:
        assert [tuple(r) for r in shared[name].collect()] == [tuple(r) for r in alone[name].collect()], name
    for df in cached:
        df.unpersist()


def test_columns_are_checked_and_read_by_name(spark, tmp_path):
    out = str(tmp_path / "named")
    rows = spark.createDataFrame([(1.5, " SP"), (2.5, "SP")], "revenue double, customer_state string")
    export_table(rows, f"{out}/revenue_by_state")
    export_table(spark.createDataFrame([("x", 1, 2)], "customer_state string, order_count long, extra int"), f"{out}/orders_by_state")
    check = {r.table: r for r in contracts.column_check(spark, out, ["revenue_by_state", "orders_by_state", "top_sellers"]).collect()}
    assert not check["revenue_by_state"].columns_ok and check["revenue_by_state"].missing_columns == []
    assert check["orders_by_state"].extra_columns == ["extra"] and not check["orders_by_state"].columns_ok
    assert not check["top_sellers"].columns_ok and check["top_sellers"].missing_columns
    back = {r.customer_state: r.revenue for r in read_table(spark, out, "revenue_by_state").collect()}
    assert back == {" SP": 1.5, "SP": 2.5}
