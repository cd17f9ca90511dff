"""The full refresh: every published table from tables that are written once.

From the source tables (``refresh``): the lines and the order-grain table of
``operators.factorised`` are written to the shared folder, without the rows that
payments and reviews would multiply; the order-grain table is bucketed by
order_id, so that no output exchanges orders again.

From joined rows (``refresh_facts``, e.g. a stream snapshot): the columns the
outputs read are written once as Parquet; ``checkpoint`` mode uses
``Dataset.checkpoint()`` instead, which keeps the order_id partitioning.

Either way a lost executor re-reads files instead of re-running the joins, each
dimension's measures are computed once (small, cached), every output is a
projection of them, and the tables are exported on request (S9).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import factorised, marts, orders
from orderlens.session import run_folder
from orderlens.sources.sinks import export_tables
from orderlens.sources.tables import SourceTables

# Columns of the facts frame that any published output reads.
MART_COLUMNS = [
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_item_id",
    "product_id",
    "seller_id",
    "price",
    "freight_value",
    "product_category_name",
    "customer_city",
    "customer_state",
    "payment_sequential",
    "payment_type",
    "payment_installments",
    "payment_value",
    "review_id",
    "review_score",
    "review_answer_timestamp",
    "revenue",
    "review_sentiment",
    "delivery_delay_days",
    "is_late_delivery",
    "purchase_date",
]


def materialise(spark: SparkSession, facts: DataFrame, mode: str = "parquet") -> DataFrame:
    narrow = facts.select(*MART_COLUMNS)
    if mode == "checkpoint":
        return narrow.checkpoint(eager=True)
    if mode == "parquet":
        path = run_folder(spark, "facts")
        narrow.write.parquet(path)
        return spark.read.parquet(path)
    return narrow


def all_outputs(facts: DataFrame, shared: bool = True) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Every published table; with ``shared`` the per-dimension measures are
    computed once and cached. Returns the tables and the cached frames."""
    cached: list[DataFrame] = []

    def m(build):
        if not shared:
            return None
        df = build(facts).persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(df)
        return df

    state, cat, pay = m(marts.state_measures), m(marts.category_measures), m(marts.payment_measures)
    day, score, aov = m(marts.date_measures), m(marts.score_measures), m(marts.aov_measures)
    sentiment = m(marts.sentiment_measures)
    f = facts
    tables = {
        "kpi_summary": marts.kpi_summary(f),
        "kpi_summary_order_level": orders.kpi_summary_order_level(f),
        "average_payment_value": marts.average_payment_value(f),
        "orders_per_day": marts.orders_per_day(f, day),
        "order_status_breakdown": marts.order_status_breakdown(f),
        "revenue_by_state": marts.revenue_by_state(f, state),
        "orders_by_state": marts.orders_by_state(f, state),
        "avg_order_value_by_state": marts.avg_order_value_by_state(f, aov),
        "top_cities_by_revenue": marts.top_cities_by_revenue(f),
        "revenue_by_category": marts.revenue_by_category(f, cat),
        "top_products": marts.top_products(f),
        "top_sellers": marts.top_sellers(f),
        "freight_vs_price_by_category": marts.freight_vs_price_by_category(f, cat),
        "orders_by_payment_type": marts.orders_by_payment_type(f, pay),
        "revenue_by_payment_type": marts.revenue_by_payment_type(f, pay),
        "installments_distribution": marts.installments_distribution(f),
        "avg_payment_by_type": marts.avg_payment_by_type(f, pay),
        "review_distribution": marts.review_distribution(f, sentiment),
        "review_score_distribution": marts.review_score_distribution(f, score),
        "review_score_by_state": marts.review_score_by_state(f, state),
        "review_score_by_category": marts.review_score_by_category(f, cat),
        "late_delivery_by_state": marts.late_delivery_by_state(f, state),
        "on_time_vs_late_delivery": marts.on_time_vs_late_delivery(f),
        "average_delay_by_state": marts.average_delay_by_state(f, state),
        "delay_trend_over_time": marts.delay_trend_over_time(f, day),
        "delay_vs_review_score": marts.delay_vs_review_score(f, score),
        "decision_support": marts.decision_support(f, state, cat, pay, sentiment),
    }
    return tables, cached


def grain_outputs(g: factorised.OrderGrain, shared: bool = True) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Every published table from the order-grain tables; the measures are cached with ``shared``."""
    cached: list[DataFrame] = []

    def m(df: DataFrame) -> DataFrame:
        if shared:
            cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    state, cat = m(factorised.state_measures(g)), m(factorised.category_measures(g))
    paid = m(factorised.payment_rows(g))
    pay, score, day = m(factorised.payment_measures(paid)), m(factorised.score_measures(g)), m(factorised.date_measures(g))
    sentiment = m(factorised.sentiment_measures(score))
    tables = {
        "kpi_summary": factorised.kpi_summary(g),
        "kpi_summary_order_level": factorised.kpi_summary_order_level(g),
        "average_payment_value": marts.average_payment_value(None, factorised.payment_total(paid)),
        "orders_per_day": marts.orders_per_day(None, day),
        "order_status_breakdown": marts.order_status_breakdown(None, factorised.status_measures(g)),
        "revenue_by_state": marts.revenue_by_state(None, state),
        "orders_by_state": marts.orders_by_state(None, state),
        "avg_order_value_by_state": marts.avg_order_value_by_state(None, factorised.aov_measures(g)),
        "top_cities_by_revenue": marts.top_cities_by_revenue(None, measures=factorised.city_measures(g)),
        "revenue_by_category": marts.revenue_by_category(None, cat),
        "top_products": marts.top_products(None, measures=factorised.line_revenue(g, "product_id")),
        "top_sellers": marts.top_sellers(None, measures=factorised.line_revenue(g, "seller_id")),
        "freight_vs_price_by_category": marts.freight_vs_price_by_category(None, cat),
        "orders_by_payment_type": marts.orders_by_payment_type(None, pay),
        "revenue_by_payment_type": marts.revenue_by_payment_type(None, pay),
        "installments_distribution": marts.installments_distribution(None, factorised.installment_measures(paid)),
        "avg_payment_by_type": marts.avg_payment_by_type(None, pay),
        "review_distribution": marts.review_distribution(None, sentiment),
        "review_score_distribution": marts.review_score_distribution(None, score),
        "review_score_by_state": marts.review_score_by_state(None, state),
        "review_score_by_category": marts.review_score_by_category(None, cat),
        "late_delivery_by_state": marts.late_delivery_by_state(None, state),
        "on_time_vs_late_delivery": marts.on_time_vs_late_delivery(None, factorised.delivery_measures(g)),
        "average_delay_by_state": marts.average_delay_by_state(None, state),
        "delay_trend_over_time": marts.delay_trend_over_time(None, day),
        "delay_vs_review_score": marts.delay_vs_review_score(None, score),
        "decision_support": marts.decision_support(None, state, cat, pay, sentiment),
    }
    return tables, cached


class Outputs(dict):
    """The published tables of a refresh, by name; ``release`` (or leaving the ``with``) frees what they hold."""

    def __init__(self, tables: dict[str, DataFrame], cached: list[DataFrame], grain: factorised.OrderGrain | None = None):
        super().__init__(tables)
        self._cached, self._grain = cached, grain

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()
        self._cached = []
        if self._grain:
            self._grain.drop()

    def __enter__(self) -> Outputs:
        return self

    def __exit__(self, *error) -> None:
        self.release()


def run_concurrently(outputs: dict[str, DataFrame], action: Callable[[str, DataFrame], None], threads: int = 8):
    """Run one action per output as concurrent Spark jobs of this application.

    The outputs are small, independent aggregations over the same facts; with
    several jobs in flight the cluster stays busy while each job's final,
    single-partition stages run.
    """
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for f in [pool.submit(action, name, df) for name, df in outputs.items()]:
            f.result()


def refresh(spark: SparkSession, tables: SourceTables, out_dir: str | None = None, shared: bool = True, threads: int = 8) -> Outputs:
    """Run the whole refresh; export to ``out_dir`` when given.

    Returns the published tables (lazy frames over the written ones). Without
    ``out_dir`` the caller releases them when done.
    """
    grain = factorised.order_grain(tables)
    return _exported(Outputs(*grain_outputs(grain, shared), grain), out_dir, threads)


def refresh_facts(
    spark: SparkSession,
    facts: DataFrame,
    out_dir: str | None = None,
    mode: str = "parquet",
    shared: bool = True,
    threads: int = 8,
) -> Outputs:
    """The refresh from an already-built facts frame (e.g. a stream snapshot)."""
    facts = materialise(spark, facts, mode)
    return _exported(Outputs(*all_outputs(facts, shared)), out_dir, threads)


def _exported(outputs: Outputs, out_dir: str | None, threads: int) -> Outputs:
    if out_dir:
        with outputs:
            run_concurrently(outputs, lambda name, df: export_tables({name: df}, out_dir), threads)
    return outputs
