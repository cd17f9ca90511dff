"""A27 order-level frame and A2 order-level KPI.

One row per order: the representative row is the latest by (purchase time,
review answer time), nulls losing, with a total order over the remaining
columns so the choice is deterministic; plus the order's summed revenue.

Computed as an aggregation, not a window: ``max(struct(ordering..., values...))``
and ``sum(revenue)`` grouped by order_id. Both have partial aggregation, so an
order holding a large share of all rows is reduced on every map task before
the shuffle instead of landing whole in one task (a window over order_id
would have to sort all of that order's rows in one partition). Struct
comparison is field by field with null smallest, i.e. "descending, nulls
last" for the maximum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.functions.money import money_sum
from orderlens.operators.marts import avg_parts, kpi_columns

# Ordering of the representative row: latest purchase, latest review answer,
# then ids and the delivery date. Every order-level output is a function of
# these keys, so narrower projections pick the same values as the full one.
ORDER_KEYS = [
    "order_purchase_timestamp",
    "review_answer_timestamp",
    "review_id",
    "order_item_id",
    "payment_sequential",
    "order_delivered_customer_date",
]


def order_level(facts: DataFrame, value_columns: list[str] | None = None) -> DataFrame:
    if value_columns is None:
        value_columns = [c for c in S.ENRICHED_COLUMNS + S.DERIVED_COLUMNS if c != "order_id" and c in facts.columns]
    ordered = ORDER_KEYS + [c for c in value_columns if c not in ORDER_KEYS]
    rep = facts.groupBy("order_id").agg(
        F.max(F.struct(*ordered)).alias("rep"),
        money_sum("revenue").alias("order_revenue_exact"),
    )
    keep = [c for c in ordered if c in value_columns]
    return rep.select(
        "order_id",
        *[F.col("rep." + c).alias(c) for c in keep],
        F.round("order_revenue_exact", 2).cast("double").alias("order_revenue"),
        F.col("order_revenue_exact"),
    )


def kpi_summary_order_level(facts: DataFrame) -> DataFrame:
    """A2: the KPI row over one representative row per order.

    Revenue is the sum of the orders' (fanned-out) row revenue, as published
    by the reference; only the review average and late rate differ from A1.
    """
    orders = order_level(facts.where(F.col("order_id").isNotNull()), ["review_score", "is_late_delivery"])
    agg = orders.agg(
        F.sum("order_revenue_exact").alias("rev"),
        F.count(F.lit(1)).alias("orders"),
        *avg_parts("review_score", "score"),
        *avg_parts("is_late_delivery", "late", scale=0),
    )
    return agg.select(*kpi_columns())
