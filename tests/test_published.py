"""Versioned publications, the date-partitioned snapshot, reload rejects, series that span partitions."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.operators import trends
from orderlens.sources import snapshot, versions
from orderlens.sources.sinks import export_tables, reload_rejects


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def some(spark, rows):
    return {
        "revenue_by_state": spark.createDataFrame(rows, "customer_state string, revenue double"),
        "orders_by_state": spark.createDataFrame([], "customer_state string, order_count long"),
    }


def test_manifest_commits_a_version_as_a_whole(spark, tmp_path):
    out, names = str(tmp_path), ["revenue_by_state", "orders_by_state", "top_sellers"]
    assert [r.status for r in versions.manifest_report(spark, out, names).collect()] == ["error"] * 3
    versions.publish_tables(some(spark, [("SP", 1.0)]), out, commit=False)
    assert versions.read_published(spark, out, "revenue_by_state").count() == 0
    first = versions.manifest_report(spark, out, names).collect()
    assert {(r.status, r.broken) for r in first} == {("error", 1)}
    versions.publish_tables(some(spark, [("SP", 1.0), ("RJ", 2.0)]), out)
    report = {r.table: (r.exists, r.row_count, r.status, r.columns_ok, r.broken) for r in versions.manifest_report(spark, out, names).collect()}
    assert report == {
        "revenue_by_state": (True, 2, "ok", True, 1), "orders_by_state": (True, 0, "warning", True, 1), "top_sellers": (False, 0, "error", False, 1),
    }
    versions.publish_tables(some(spark, [("MG", 3.0)]), out, commit=False)  # breaks off: the version before it stays
    back = versions.read_published(spark, out, "revenue_by_state")
    assert sorted(r.customer_state for r in back.collect()) == ["RJ", "SP"] and back.schema == S.OUTPUT_SCHEMAS["revenue_by_state"]
    versions.publish_tables(some(spark, [("MG", 3.0)]), out)
    assert [r.customer_state for r in versions.read_published(spark, out, "revenue_by_state").collect()] == ["MG"]
    text = plan(versions.manifest_report(spark, out, names))
    assert "csv" not in text.lower().replace("csv,", "") or "Scan csv" not in text


def test_snapshot_prunes_months_and_reads_footers(spark, tmp_path):
    days = spark.range(800).select(
        F.when(F.col("id") % 50 != 0, F.expr("date_add(date'2017-01-15', cast(id as int))")).alias("purchase_date"), F.col("id").alias("order_id")
    )
    path = str(tmp_path / "s")
    snapshot.write_snapshot(days, path)
    assert snapshot.read_dates(spark, path).count() == 800
    part = snapshot.read_dates(spark, path, "2017-02-10", dt.date(2017, 3, 5))
    assert part.count() == days.where("purchase_date between '2017-02-10' and '2017-03-05'").count()
    text = plan(part)
    assert "PartitionFilters: [isnotnull(purchase_month" in text and "201702" in text and "201703" in text
    assert snapshot.read_dates(spark, path, start="2019-03-01").count() == days.where("purchase_date >= '2019-03-01'").count()
    bounds = snapshot.footer_bounds(spark, path)
    assert "PushedAggregation: [MIN(purchase_date), MAX(purchase_date)]" in plan(bounds)
    assert tuple(bounds.first()) == tuple(days.agg(F.min("purchase_date"), F.max("purchase_date")).first())


def test_reload_rejects_counts_each_column(spark, tmp_path):
    rows = [("SP", "1.5"), ("RJ", "x"), (None, None), ("MG", "1e400x"), ("", "7")]
    bad = {"revenue_by_state": spark.createDataFrame(rows, "customer_state string, revenue string"), "orders_by_state": spark.createDataFrame([("a",)], "customer_state string")}
    export_tables(bad, str(tmp_path))
    got = {(r.table, r.column): (r["values"], r.rejected) for r in reload_rejects(spark, str(tmp_path)).collect()}
    assert got == {
        ("revenue_by_state", "customer_state"): (3, 0), ("revenue_by_state", "revenue"): (4, 2),
        ("orders_by_state", "customer_state"): (1, 0), ("orders_by_state", "order_count"): (0, 0),
    }
    assert reload_rejects(spark, str(tmp_path / "none")).collect() == []


def test_a_series_of_half_the_rows_spans_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 14 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
        df = spark.range(3000).select(keys.alias("k"), F.expr("date_add(date'2000-01-01', cast(id as int))").alias("d"), (F.col("id") % 11).cast("double").alias("y"))
        got = trends.with_position(df, "d", ["k"])
        rows = sorted(((r.k is None, r.k or ""), r.d, r.position) for r in got.collect())
        seen = {}
        for k, _, position in rows:
            assert position == seen.get(k, 0)
            seen[k] = position + 1
        assert seen[(False, "hot")] == 1500 and len(rows) == 3000
        average = trends.moving_average(df, "d", "y", window=3, partition_cols=["k"])
        hot = [(r.y, r.moving_average) for r in average.where("k = 'hot'").orderBy("d").collect()]
        for i, (_, mean) in enumerate(hot):
            ys = [y for y, _ in hot[max(0, i - 2) : i + 1]]
            assert abs(mean - sum(ys) / len(ys)) < 1e-12
        assert average.where("k is null and moving_average is not null").count() == average.where("k is null").count() > 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
