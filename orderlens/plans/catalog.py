"""The query catalog: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the test-data adapter and runs
over whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.functions.cleaning import clean
from orderlens.operators import contracts, factorised, filters, insights, marts, orders, trends
from orderlens.plans.facts import enriched, facts
from orderlens.plans.refresh import refresh
from orderlens.plans.stream_job import (
    streamed_state,
    awkward_text_roundtrip,
    csv_snapshot_roundtrip,
    ingest_rejects,
    ingest_roundtrip,
    landing_csv_roundtrip,
    run_folder,
)
from orderlens.sources import snapshot, versions
from orderlens.sources.sinks import export_tables, read_table, reload_rejects
from orderlens.sources.tables import read_translation, translate_categories
from orderlens.sources.testdata import load_testdata
from orderlens.streaming.batches import kpi_from_state, revenue_from_state

Query = Callable[[SparkSession, str], DataFrame]


def _on_facts(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(facts(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _on_tables(fn) -> Query:
    return lambda spark, sf_dir: fn(load_testdata(spark, sf_dir))


# Outputs that are answered without the fan-out of the joins.
FACTORISED: dict[str, Query] = {
    "revenue_by_state": _on_tables(lambda t: marts.revenue_by_state(None, factorised.revenue_by(t, "customer_state"))),
    "top_cities_by_revenue": _on_tables(lambda t: marts.top_cities_by_revenue(None, measures=factorised.revenue_by(t, "customer_city"))),
    "revenue_by_category": _on_tables(lambda t: marts.revenue_by_category(None, factorised.revenue_by(t, "product_category_name"))),
    "top_products": _on_tables(lambda t: marts.top_products(None, measures=factorised.revenue_by(t, "product_id"))),
    "top_sellers": _on_tables(lambda t: marts.top_sellers(None, measures=factorised.revenue_by(t, "seller_id"))),
    "revenue_by_payment_type": _on_tables(lambda t: marts.revenue_by_payment_type(None, factorised.revenue_by(t, "payment_type"))),
    "decision_support": _on_tables(lambda t: marts.decision_support(None, sets=factorised.decision_sets(t))),
}


OUTPUTS = [
    marts.kpi_summary,
    orders.kpi_summary_order_level,
    marts.average_payment_value,
    marts.orders_per_day,
    marts.order_status_breakdown,
    marts.revenue_by_state,
    marts.orders_by_state,
    marts.avg_order_value_by_state,
    marts.top_cities_by_revenue,
    marts.revenue_by_category,
    marts.top_products,
    marts.top_sellers,
    marts.freight_vs_price_by_category,
    marts.orders_by_payment_type,
    marts.revenue_by_payment_type,
    marts.installments_distribution,
    marts.avg_payment_by_type,
    marts.review_distribution,
    marts.review_score_distribution,
    marts.review_score_by_state,
    marts.review_score_by_category,
    marts.late_delivery_by_state,
    marts.on_time_vs_late_delivery,
    marts.average_delay_by_state,
    marts.delay_trend_over_time,
    marts.delay_vs_review_score,
    marts.decision_support,
]


def contract_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh, export every table, then check the exported folder (Q1-Q4)."""
    started = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    out_dir = run_folder(spark, "outputs")
    refresh(spark, load_testdata(spark, sf_dir), out_dir=out_dir)
    report = contracts.contract_report(spark, out_dir)
    columns = contracts.column_check(spark, out_dir).select("table", "columns_ok")
    return report.withColumn("modified_since_start", F.col("last_modified") >= F.lit(started)).drop("last_modified").join(columns, "table", "left")


# Parameters of the registered view-filter queries (dashboard selections).
RANGE_START, RANGE_END = dt.date(1996, 1, 1), dt.date(1998, 12, 31)
SELECTED_STATE = "NATION_7"
SELECTED_CATEGORY = "Brand#7"


def export_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export two tables as CSV, reload them typed by name, aggregate."""
    out_dir = run_folder(spark, "reload")
    f = facts(spark, sf_dir)
    made = {"revenue_by_state": marts.revenue_by_state(f), "top_products": marts.top_products(f)}
    export_tables(made, out_dir)
    total = F.sum(F.col("revenue").cast("decimal(20,2)")).cast("double")
    parts = [
        read_table(spark, out_dir, name).agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(F.lit(name).alias("name"), "n", "total")
        for name in made
    ]
    return parts[0].unionByName(parts[1])


def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q4 at write time: a whole publication, then one that breaks off; the report of the manifest."""
    out_dir = run_folder(spark, "published")
    started = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    with refresh(spark, load_testdata(spark, sf_dir)) as outputs:
        versions.publish_tables({n: outputs[n] for n in S.EXPECTED_OUTPUTS}, out_dir)
        versions.publish_tables({n: outputs[n].limit(0) for n in ("top_sellers", "revenue_by_state")}, out_dir, commit=False)
    report = versions.manifest_report(spark, out_dir)
    return report.withColumn("modified_since_start", F.col("last_modified") >= F.lit(started)).drop("last_modified")


def contract_summary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q2 overall: an export that lacks one table and holds an empty one."""
    out_dir = run_folder(spark, "partial")
    f = facts(spark, sf_dir)
    made = {"revenue_by_state": marts.revenue_by_state(f), "order_status_breakdown": marts.order_status_breakdown(f).limit(0)}
    export_tables(made, out_dir)
    report = contracts.contract_report(spark, out_dir, [*made, "top_products"])
    return contracts.contract_summary(report).select(
        "status", F.array_join("missing_tables", ",").alias("missing_tables"), F.array_join("empty_tables", ",").alias("empty_tables")
    )


def planted_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that don't parse, planted in exported tables, counted by the reload."""
    out_dir = run_folder(spark, "planted")
    f = facts(spark, sf_dir)
    day = marts.orders_per_day(f)
    nth = F.month("purchase_date")
    day = day.select(
        F.when(nth == 2, "no date").otherwise(F.col("purchase_date").cast("string")).alias("purchase_date"),
        F.when(nth == 3, F.concat(F.col("order_count").cast("string"), F.lit("x"))).when(nth == 4, None).otherwise(F.col("order_count").cast("string")).alias("order_count"),
    )
    state = marts.revenue_by_state(f).select("customer_state", F.when(F.col("customer_state") < "NATION_2", "1,5").otherwise(F.col("revenue").cast("string")).alias("revenue"))
    export_tables({"orders_per_day": day, "revenue_by_state": state}, out_dir)
    return reload_rejects(spark, out_dir)


def translated_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the category translation with a byte order mark, read it, join it, aggregate by the English name."""
    path = run_folder(spark, "translation")
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    names = part.select("p_brand").distinct().where(F.expr("substring(p_brand, -1) <> '5'"))
    mark = F.lit("\ufeffproduct_category_name,product_category_name_english").alias("value")
    lines = names.select(F.concat("p_brand", F.lit(",group "), F.expr("substring(p_brand, -1)")).alias("value"), F.lit(1).alias("_place"))
    rows = spark.range(1).select(mark, F.lit(0).alias("_place")).unionByName(lines)
    rows.coalesce(1).sortWithinPartitions("_place").select("value").write.text(path)
    named = translate_categories(marts.category_measures(facts(spark, sf_dir)), read_translation(spark, path))
    english = F.coalesce("product_category_name_english", "product_category_name").alias("category")
    by_name = named.groupBy(english).agg(F.sum("revenue_exact").alias("exact"), F.count(F.lit(1)).alias("categories"))
    return by_name.select("category", F.round("exact", 2).cast("double").alias("revenue"), "categories")


def snapshot_orders_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 on the partitioned snapshot."""
    path = run_folder(spark, "by-month")
    snapshot.write_snapshot(facts(spark, sf_dir).select("order_id", "purchase_date", "delivery_delay_days"), path)
    return marts.orders_per_day(snapshot.read_dates(spark, path, RANGE_START, RANGE_END))


def snapshot_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 from the footers of the partitioned snapshot."""
    path = run_folder(spark, "by-month")
    snapshot.write_snapshot(facts(spark, sf_dir).select("order_id", "purchase_date", "delivery_delay_days"), path)
    return snapshot.footer_bounds(spark, path).select(F.col("lo").alias("date_start"), F.col("hi").alias("date_end"))


def daily_by_state(f: DataFrame) -> DataFrame:
    return f.where(F.col("purchase_date").isNotNull()).groupBy("customer_state", "purchase_date").agg(F.countDistinct("order_id").alias("order_count"))


def null_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN, blank, infinite and malformed text in string and numeric fields."""
    o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    key, n = F.col("o_orderkey"), F.col("o_orderkey") % 6
    price = F.when(n == 0, "NaN").when(n == 1, "").when(n == 2, "Infinity").when(n == 3, "abc").otherwise(F.col("o_totalprice").cast("string"))
    kind = F.when(key % 3 == 0, "").when(key % 3 == 1, '"NaN"').otherwise(F.col("o_orderpriority"))
    raw = o.select(key.cast("string").alias("order_id"), price.alias("price"), kind.alias("payment_type"))
    c = clean(raw)
    return c.select(F.col("order_id").cast("long").alias("order_id"), "price", "payment_type", F.col("price").isNull().cast("int").alias("unusable"))


def published_order(f: DataFrame) -> DataFrame:
    """O1: the place of each row in a published (sorted) table."""
    rows = marts.revenue_by_state(f).coalesce(1)
    return rows.withColumn("place", F.monotonically_increasing_id() + 1)


def _daily(f):
    return marts.orders_per_day(f)


def derived_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["orders_trend_forecast"] = _on_facts(
        lambda f: trends.linear_trend_forecast(_daily(f), "purchase_date", "order_count", periods=30, scale=0)
    )
    q["orders_moving_average"] = _on_facts(
        lambda f: trends.moving_average(_daily(f), "purchase_date", "order_count", window=7)
    )
    q["orders_trend_summary"] = _on_facts(
        lambda f: trends.trend_summary(_daily(f), "purchase_date", "order_count", scale=0)
    )
    by_state = {"partition_cols": ["customer_state"]}
    q["orders_trend_by_state"] = _on_facts(lambda f: trends.trend_summary(daily_by_state(f), "purchase_date", "order_count", scale=0, **by_state))
    q["orders_moving_average_by_state"] = _on_facts(
        lambda f: trends.moving_average(daily_by_state(f), "purchase_date", "order_count", window=7, **by_state)
    )
    q["orders_forecast_by_state"] = _on_facts(
        lambda f: trends.linear_trend_forecast(daily_by_state(f), "purchase_date", "order_count", periods=5, scale=0, **by_state)
    )
    q["revenue_concentration"] = _on_facts(
        lambda f: trends.concentration_index(marts.revenue_by_state(f), "revenue")
    )
    q["freight_price_correlation"] = _on_facts(
        lambda f: trends.correlation(marts.freight_vs_price_by_category(f), "avg_price", "avg_freight", 2)
    )
    q["date_bounds"] = _on_facts(lambda f: filters.date_bounds(_daily(f)))
    q["daily_orders_in_range"] = _on_facts(lambda f: filters.date_range(_daily(f), RANGE_START, RANGE_END))
    q["state_late_delivery_selected"] = _on_facts(
        lambda f: filters.equals_or_all(marts.late_delivery_by_state(f), "customer_state", SELECTED_STATE)
    )
    q["category_price_ranking"] = _on_facts(
        lambda f: filters.project_sorted(
            marts.freight_vs_price_by_category(f), ["product_category_name", "avg_price"], "avg_price"
        )
    )
    q["category_price_selected"] = _on_facts(
        lambda f: filters.equals_or_all(marts.freight_vs_price_by_category(f), "product_category_name", SELECTED_CATEGORY)
    )
    q["payment_selected"] = _on_facts(lambda f: filters.equals_or_all(marts.avg_payment_by_type(f), "payment_type", "voucher"))
    q["state_review_all"] = _on_facts(
        lambda f: filters.equals_or_all(marts.review_score_by_state(f), "customer_state", filters.ALL)
    )
    q["delay_trend_in_range"] = _on_facts(lambda f: filters.date_range(marts.delay_trend_over_time(f), RANGE_START, RANGE_END))
    q["category_revenue_head"] = _on_facts(lambda f: marts.revenue_by_category(f).limit(15))
    q["published_order"] = _on_facts(published_order)
    q["export_reload"] = export_reload
    q["null_normalisation"] = null_normalisation
    q["awkward_text_roundtrip"] = awkward_text_roundtrip
    q["ingest_rejects"] = ingest_rejects
    q["stream_ingest_roundtrip"] = ingest_roundtrip
    q["snapshot_csv_roundtrip"] = csv_snapshot_roundtrip
    q["landing_csv_roundtrip"] = landing_csv_roundtrip
    q["contract_report"] = contract_roundtrip
    q["contract_summary"] = contract_summary_roundtrip
    q["manifest_report"] = manifest_roundtrip
    q["reload_rejects"] = planted_rejects
    q["translated_categories"] = translated_categories
    q["snapshot_orders_in_range"] = snapshot_orders_in_range
    q["snapshot_date_bounds"] = snapshot_date_bounds
    q["stream_state_kpi"] = lambda spark, sf_dir: kpi_from_state(streamed_state(spark, sf_dir))
    q["stream_state_revenue"] = lambda spark, sf_dir: revenue_from_state(streamed_state(spark, sf_dir))
    for name, fn in insights.BLOCKS.items():
        q["insight_" + name] = _on_facts(fn)
    return q


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {"enriched_orders": enriched}
    q["order_level"] = _on_facts(lambda f: orders.order_level(f).drop("order_revenue_exact"))
    for fn in OUTPUTS:
        q[fn.__name__] = FACTORISED.get(fn.__name__) or _on_facts(fn)
    q.update(derived_queries())
    return q
