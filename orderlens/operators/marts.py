"""The published aggregates over the facts frame.

Each dimension has one *measures* aggregation that computes every metric any
output needs for that dimension (state, category, payment type, date, score).
An output is a projection of its dimension's measures, so:

* called alone, Catalyst prunes the unused aggregate expressions and the plan
  is the minimal partial/final HashAggregate for that output;
* in the refresh job the measures are computed once per dimension and every
  output of that dimension projects the same small result.

Distinct-order counts are ``countDistinct(order_id)``; Spark plans them as a
(key, order_id) partial aggregation: each task first reduces its rows to one
per (key, order), so only that narrow result is exchanged, spread by order_id
(a hot key value does not concentrate in one task).

Money is summed exactly (see ``functions.money``); sorting uses the exact
value with the group key as tie-break, rounding happens in the final
projection only. Null keys sort last on ascending outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.derive import delivery_status
from orderlens.functions.money import MONEY, MONEY_SCALE, money, money_sum, ratio, round_div, to_cents

TOP_N = 10


def _by_metric(m: DataFrame, metric: str | Column, key: str, top: int | None = None) -> DataFrame:
    metric = F.col(metric) if isinstance(metric, str) else metric
    ordered = m.orderBy(metric.desc_nulls_last(), F.col(key).asc_nulls_last())
    return ordered.limit(top) if top else ordered


def _by_key(m: DataFrame, key: str) -> DataFrame:
    return m.orderBy(F.col(key).asc_nulls_last())


# --------------------------------------------------------------------------
# Dimension measures
# --------------------------------------------------------------------------

def avg_parts(c: str, prefix: str, scale: int = MONEY_SCALE) -> list[Column]:
    """Exact sum and count of the values of a measure; with a scale by the money rule, so what is no amount counts in neither."""
    col = money(c) if scale else F.col(c)
    total = F.sum(col) if scale else F.sum(col).cast("long")
    return [total.alias(prefix + "_sum"), F.count(col).alias(prefix + "_n")]


def avg_exact(prefix: str) -> Column:
    """Unrounded average from its parts, used for ordering only."""
    return ratio(F.col(prefix + "_sum"), F.col(prefix + "_n"))


def avg_out(prefix: str, digits: int = 2, scale: int = MONEY_SCALE) -> Column:
    return round_div(F.col(prefix + "_sum"), F.col(prefix + "_n"), digits, scale)


def state_measures(facts: DataFrame) -> DataFrame:
    return facts.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum("is_late_delivery").cast("long").alias("late_rows"),
        F.countDistinct("order_id").alias("unique_orders"),
        money_sum("revenue").alias("revenue_exact"),
        *avg_parts("review_score", "score"),
        *avg_parts("delivery_delay_days", "delay", scale=0),
    )


def category_measures(facts: DataFrame) -> DataFrame:
    return facts.groupBy("product_category_name").agg(
        money_sum("revenue").alias("revenue_exact"),
        *avg_parts("price", "price"),
        *avg_parts("freight_value", "freight"),
        *avg_parts("review_score", "score"),
    )


def payment_measures(facts: DataFrame) -> DataFrame:
    return facts.groupBy("payment_type").agg(
        F.countDistinct("order_id").alias("order_count"),
        money_sum("revenue").alias("revenue_exact"),
        *avg_parts("payment_value", "payment"),
    )


def date_measures(facts: DataFrame) -> DataFrame:
    return (
        facts.where(F.col("purchase_date").isNotNull())
        .groupBy("purchase_date")
        .agg(
            F.countDistinct("order_id").alias("order_count"),
            *avg_parts("delivery_delay_days", "delay", scale=0),
        )
    )


def score_measures(facts: DataFrame) -> DataFrame:
    return facts.groupBy("review_score").agg(
        F.count(F.lit(1)).alias("count"),
        *avg_parts("delivery_delay_days", "delay", scale=0),
    )


def revenue_by(facts: DataFrame, key: str) -> DataFrame:
    return facts.groupBy(key).agg(money_sum("revenue").alias("revenue_exact"))


def _count_by(facts: DataFrame, key: str | Column, name: str) -> DataFrame:
    col = F.col(key) if isinstance(key, str) else key
    return facts.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def _m(measures: DataFrame | None, build, facts: DataFrame) -> DataFrame:
    return measures if measures is not None else build(facts)


# --------------------------------------------------------------------------
# Headline figures (1-row outputs, zeros on empty input)
# --------------------------------------------------------------------------

def kpi_columns() -> list[Column]:
    """KPI row from rev (exact), orders, score_sum/score_n, late_sum/late_n."""
    revenue = F.coalesce(F.col("rev"), F.lit(0).cast(MONEY))
    orders = F.coalesce(F.col("orders"), F.lit(0)).cast("long")
    return [
        to_cents(revenue).alias("total_revenue"),
        orders.alias("total_orders"),
        F.coalesce(round_div(revenue, orders, 2, MONEY_SCALE), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(avg_out("score"), F.lit(0.0)).alias("avg_review_score"),
        F.coalesce(avg_out("late", 4, 0), F.lit(0.0)).alias("late_delivery_rate"),
    ]


def kpi_summary(facts: DataFrame) -> DataFrame:
    """A1: revenue, distinct orders, order value, review score, late rate."""
    agg = facts.agg(
        money_sum("revenue").alias("rev"),
        F.countDistinct("order_id").alias("orders"),
        *avg_parts("review_score", "score"),
        *avg_parts("is_late_delivery", "late", scale=0),
    )
    return agg.select(*kpi_columns())


def average_payment_value(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A3: mean payment value over non-null values, 0.0 when there are none."""
    m = measures if measures is not None else facts.agg(*avg_parts("payment_value", "payment"))
    return m.select(
        F.coalesce(avg_out("payment"), F.lit(0.0)).alias("average_payment_value")
    )


# --------------------------------------------------------------------------
# Date
# --------------------------------------------------------------------------

def orders_per_day(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A4"""
    m = _m(measures, date_measures, facts)
    return _by_key(m, "purchase_date").select("purchase_date", "order_count")


def delay_trend_over_time(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A25"""
    m = _m(measures, date_measures, facts)
    return _by_key(m, "purchase_date").select("purchase_date", avg_out("delay", 2, 0).alias("avg_delay_days"))


# --------------------------------------------------------------------------
# Status
# --------------------------------------------------------------------------

def status_measures(facts: DataFrame) -> DataFrame:
    return facts.groupBy("order_status").agg(F.countDistinct("order_id").alias("order_count"))


def order_status_breakdown(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A5"""
    m = _m(measures, status_measures, facts)
    return _by_metric(m, "order_count", "order_status")


# --------------------------------------------------------------------------
# Geography
# --------------------------------------------------------------------------

def revenue_by_state(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A6"""
    m = _m(measures, state_measures, facts)
    return _by_metric(m, "revenue_exact", "customer_state").select(
        "customer_state", to_cents(F.col("revenue_exact")).alias("revenue")
    )


def orders_by_state(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A7"""
    m = _m(measures, state_measures, facts)
    return _by_metric(m, "unique_orders", "customer_state").select(
        "customer_state", F.col("unique_orders").alias("order_count")
    )


def aov_measures(facts: DataFrame) -> DataFrame:
    """Revenue per (state, order), then its sum and count per state.

    The inner grouping needs no exchange: facts are already hash-partitioned
    on order_id by the joins, which satisfies the (state, order_id) grouping.
    """
    per_order = (
        facts.where(F.col("order_id").isNotNull())
        .groupBy("customer_state", "order_id")
        .agg(money_sum("revenue").alias("order_revenue"))
    )
    return per_order.groupBy("customer_state").agg(
        F.sum("order_revenue").alias("aov_sum"), F.count(F.lit(1)).alias("aov_n")
    )


def avg_order_value_by_state(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """Revenue per (state, order), then the mean per state."""
    m = _m(measures, aov_measures, facts)
    return _by_metric(m, avg_exact("aov"), "customer_state").select(
        "customer_state", avg_out("aov").alias("avg_order_value")
    )


def top_cities_by_revenue(facts: DataFrame, top_n: int = TOP_N, measures: DataFrame | None = None) -> DataFrame:
    """A9"""
    m = measures if measures is not None else revenue_by(facts, "customer_city")
    return _by_metric(m, "revenue_exact", "customer_city", top_n).select(
        "customer_city", to_cents(F.col("revenue_exact")).alias("revenue")
    )


def review_score_by_state(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A20"""
    m = _m(measures, state_measures, facts)
    return _by_metric(m, avg_exact("score"), "customer_state").select(
        "customer_state", avg_out("score").alias("avg_review_score")
    )


def late_delivery_by_state(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """Rows, late rows, distinct orders and late rows / rows per state."""
    m = _m(measures, state_measures, facts)
    return _by_metric(m, ratio(F.col("late_rows"), F.col("total_rows")), "customer_state").select(
        "customer_state",
        "total_rows",
        "late_rows",
        "unique_orders",
        round_div(F.col("late_rows"), F.col("total_rows"), 4).alias("late_delivery_rate"),
    )


def average_delay_by_state(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A24"""
    m = _m(measures, state_measures, facts)
    return _by_metric(m, avg_exact("delay"), "customer_state").select(
        "customer_state", avg_out("delay", 2, 0).alias("avg_delay_days")
    )


# --------------------------------------------------------------------------
# Product
# --------------------------------------------------------------------------

def revenue_by_category(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A10"""
    m = _m(measures, category_measures, facts)
    return _by_metric(m, "revenue_exact", "product_category_name").select(
        "product_category_name", to_cents(F.col("revenue_exact")).alias("revenue")
    )


def top_products(facts: DataFrame, top_n: int = TOP_N, measures: DataFrame | None = None) -> DataFrame:
    """A11 (item-less orders form the "unknown" product)."""
    m = measures if measures is not None else revenue_by(facts, "product_id")
    return _by_metric(m, "revenue_exact", "product_id", top_n).select(
        "product_id", to_cents(F.col("revenue_exact")).alias("revenue")
    )


def top_sellers(facts: DataFrame, top_n: int = TOP_N, measures: DataFrame | None = None) -> DataFrame:
    """A12"""
    m = measures if measures is not None else revenue_by(facts, "seller_id")
    return _by_metric(m, "revenue_exact", "seller_id", top_n).select(
        "seller_id", to_cents(F.col("revenue_exact")).alias("revenue")
    )


def freight_vs_price_by_category(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A13"""
    m = _m(measures, category_measures, facts)
    return _by_metric(m, avg_exact("price"), "product_category_name").select(
        "product_category_name",
        avg_out("price").alias("avg_price"),
        avg_out("freight").alias("avg_freight"),
    )


def review_score_by_category(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A21"""
    m = _m(measures, category_measures, facts)
    return _by_metric(m, avg_exact("score"), "product_category_name").select(
        "product_category_name", avg_out("score").alias("avg_review_score")
    )


# --------------------------------------------------------------------------
# Payment
# --------------------------------------------------------------------------

def orders_by_payment_type(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """An order paid with two types counts under both."""
    m = _m(measures, payment_measures, facts)
    return _by_metric(m, "order_count", "payment_type").select("payment_type", "order_count")


def revenue_by_payment_type(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A15"""
    m = _m(measures, payment_measures, facts)
    return _by_metric(m, "revenue_exact", "payment_type").select(
        "payment_type", to_cents(F.col("revenue_exact")).alias("revenue")
    )


def installments_distribution(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """Rows per instalment count, null group last."""
    m = measures if measures is not None else _count_by(facts, "payment_installments", "payment_installments")
    return _by_key(m, "payment_installments")


def avg_payment_by_type(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """Null when a type has no payment value."""
    m = _m(measures, payment_measures, facts)
    return _by_metric(m, avg_exact("payment"), "payment_type").select(
        "payment_type", avg_out("payment").alias("avg_payment_value")
    )


# --------------------------------------------------------------------------
# Satisfaction and delivery
# --------------------------------------------------------------------------

def sentiment_measures(facts: DataFrame) -> DataFrame:
    return _count_by(facts, "review_sentiment", "review_sentiment")


def review_distribution(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """Rows per sentiment bucket."""
    return _by_metric(_m(measures, sentiment_measures, facts), "count", "review_sentiment")


def review_score_distribution(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A19"""
    m = _m(measures, score_measures, facts)
    return _by_key(m, "review_score").select("review_score", "count")


def on_time_vs_late_delivery(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A23"""
    m = measures if measures is not None else _count_by(facts, delivery_status(F.col("is_late_delivery")), "delivery_status")
    return _by_metric(m, "count", "delivery_status")


def delay_vs_review_score(facts: DataFrame, measures: DataFrame | None = None) -> DataFrame:
    """A26"""
    m = _m(measures, score_measures, facts)
    return _by_key(m, "review_score").select("review_score", avg_out("delay", 2, 0).alias("avg_delay_days"))


# --------------------------------------------------------------------------
# A28 decision support
# --------------------------------------------------------------------------

_SETS = {
    "state": ["customer_state"],
    "category": ["product_category_name"],
    "payment": ["payment_type", "order_id"],
    "sentiment": ["review_sentiment"],
}


def decision_support(
    facts: DataFrame,
    state: DataFrame | None = None,
    category: DataFrame | None = None,
    payment: DataFrame | None = None,
    sentiments: DataFrame | None = None,
    sets: DataFrame | None = None,
) -> DataFrame:
    """Leaders of four published tables plus the positive/negative row shares.

    The leaders are the first rows of the published orderings (metric desc,
    key asc), picked with ``min_by`` over (-metric, key) in one global
    aggregation over a narrow (set, key, measures) frame: one row, no sort,
    no join of 1-row frames.

    With precomputed (cached) measures the frame stacks them; ``sets`` are the
    grouping sets of ``factorised.decision_sets``; otherwise it comes from a
    single pass over the facts (``_decision_sets``), so the joins behind the
    facts run once.
    """
    if sets is not None:
        return _decision_row(sets)
    if state is None or category is None or payment is None or sentiments is None:
        stacked = _decision_sets(facts)
    else:
        stacked = _decision_stack(state, category, payment, sentiments)
    return _decision_row(stacked)


_STACK_SCHEMA = [("rev", "decimal(38,4)"), ("rows", "long"), ("late", "long"), ("orders", "long")]


def _stacked(df: DataFrame, tag: str, key: str, **measures: Column) -> DataFrame:
    return df.select(
        F.lit(tag).alias("tag"),
        F.col(key).cast("string").alias("key"),
        *[(measures.get(n, F.lit(None))).cast(t).alias(n) for n, t in _STACK_SCHEMA],
    )


def _decision_stack(state: DataFrame, category: DataFrame, payment: DataFrame, sentiments: DataFrame) -> DataFrame:
    return (
        _stacked(state, "state", "customer_state", rev=F.col("revenue_exact"), rows=F.col("total_rows"),
                 late=F.col("late_rows"))
        .unionByName(_stacked(category, "category", "product_category_name", rev=F.col("revenue_exact")))
        .unionByName(_stacked(payment, "payment", "payment_type", orders=F.col("order_count")))
        .unionByName(_stacked(sentiments, "sentiment", "review_sentiment", rows=F.col("count")))
    )


def _decision_sets(facts: DataFrame) -> DataFrame:
    """(tag, key, measures) from one grouping-sets aggregation of the facts.

    Sets: (state), (category), (payment type, order), (sentiment). The keys
    include order_id, so the order_id partitioning of the joins satisfies the
    first aggregation; the second one, over (set, key), counts distinct
    orders per payment type and passes the other sets through.
    """
    cols = ["customer_state", "product_category_name", "payment_type", "order_id", "review_sentiment"]
    sets = facts.groupingSets([list(v) for v in _SETS.values()], *cols).agg(
        money_sum("revenue").alias("rev"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("is_late_delivery").cast("long").alias("late"),
        *[F.grouping(c).alias("g_" + c) for c in cols],
    )
    tag, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, keys in _SETS.items():
        hit = F.lit(True)
        for k in keys:
            hit = hit & (F.col("g_" + k) == 0)
        tag = F.when(hit, F.lit(name)).otherwise(tag)
        key = F.when(hit, F.col(keys[0]).cast("string")).otherwise(key)
    return (
        sets.select(tag.alias("tag"), key.alias("key"), "rev", "rows", "late", "order_id")
        .groupBy("tag", "key")
        .agg(
            F.sum("rev").cast("decimal(38,4)").alias("rev"),
            F.sum("rows").cast("long").alias("rows"),
            F.sum("late").cast("long").alias("late"),
            F.count("order_id").alias("orders"),
        )
    )


def _decision_row(stacked: DataFrame) -> DataFrame:
    def leader(tag: str, metric: Column) -> Column:
        hit = F.col("tag") == tag
        return F.min_by(F.when(hit, F.col("key")), F.when(hit, F.struct(-metric, F.col("key"))))

    def share(label: str) -> Column:
        is_sent = F.col("tag") == "sentiment"
        part = F.sum(F.when(is_sent & (F.col("key") == label), F.col("rows")))
        total = F.sum(F.when(is_sent, F.col("rows")))
        return F.coalesce(round_div(F.coalesce(part, F.lit(0)), total, 4), F.lit(0.0))

    return stacked.agg(
        leader("state", F.col("rev")).alias("best_state_by_revenue"),
        leader("category", F.col("rev")).alias("top_category_by_revenue"),
        leader("payment", F.col("orders").cast("double")).alias("top_payment_type"),
        leader("state", ratio(F.col("late"), F.col("rows"))).alias("worst_state_by_late_rate"),
        share("positive").alias("positive_review_ratio"),
        share("negative").alias("negative_review_ratio"),
    )
