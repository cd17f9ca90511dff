"""Column contracts of the enriched record and of the published outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# The 36 enriched columns, in the published order, grouped by the
# table they come from. The misspelling "lenght" is part of the contract.
ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
ITEM_COLUMNS = [
    "order_item_id",
    "product_id",
    "seller_id",
    "shipping_limit_date",
    "price",
    "freight_value",
]
PRODUCT_COLUMNS = [
    "product_category_name",
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
CUSTOMER_COLUMNS = [
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
]
PAYMENT_COLUMNS = [
    "payment_sequential",
    "payment_type",
    "payment_installments",
    "payment_value",
]
REVIEW_COLUMNS = [
    "review_id",
    "review_score",
    "review_comment_title",
    "review_comment_message",
    "review_creation_date",
    "review_answer_timestamp",
]
ENRICHED_COLUMNS = (
    ORDER_COLUMNS + ITEM_COLUMNS + PRODUCT_COLUMNS + CUSTOMER_COLUMNS + PAYMENT_COLUMNS + REVIEW_COLUMNS
)

# Typing rules of the cleaning step.
TIMESTAMP_COLUMNS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "shipping_limit_date",
    "review_creation_date",
    "review_answer_timestamp",
]
DOUBLE_COLUMNS = [
    "order_item_id",
    "price",
    "freight_value",
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "payment_sequential",
    "payment_installments",
    "payment_value",
    "review_score",
]
INT_COLUMNS = ["customer_zip_code_prefix"]

# Null fills of string columns (ids and labels become "unknown",
# free-text comments become empty).
STRING_FILLS = {
    "product_category_name": "unknown",
    "customer_city": "unknown",
    "customer_state": "unknown",
    "payment_type": "unknown",
    "review_comment_title": "",
    "review_comment_message": "",
    "order_status": "unknown",
    "seller_id": "unknown",
    "product_id": "unknown",
}

# Key columns keep whatever type the source gives them (long keys join faster
# than strings); every other non-typed column is a string.
KEY_COLUMNS = ["order_id", "customer_id"]


def column_type(name: str) -> T.DataType:
    if name in TIMESTAMP_COLUMNS:
        return T.TimestampType()
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    if name in INT_COLUMNS:
        return T.IntegerType()
    return T.StringType()


# The wire format of the stream: every field a string, as the landing CSV.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in ENRICHED_COLUMNS])

# Typed contract after cleaning (keys as strings here; sources may use longs).
TYPED_SCHEMA = T.StructType([T.StructField(c, column_type(c), True) for c in ENRICHED_COLUMNS])

DERIVED_COLUMNS = [
    "revenue",
    "review_sentiment",
    "delivery_delay_days",
    "is_late_delivery",
    "purchase_date",
]


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_STR, _DBL, _LNG, _DATE = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()

# Published output schemas (one per exported table). Used by the typed reload
# (S10) and by the contract check (Q4).
OUTPUT_SCHEMAS: dict[str, T.StructType] = {
    "kpi_summary": _s(("total_revenue", _DBL), ("total_orders", _LNG), ("avg_order_value", _DBL),
                      ("avg_review_score", _DBL), ("late_delivery_rate", _DBL)),
    "kpi_summary_order_level": _s(("total_revenue", _DBL), ("total_orders", _LNG), ("avg_order_value", _DBL),
                                  ("avg_review_score", _DBL), ("late_delivery_rate", _DBL)),
    "average_payment_value": _s(("average_payment_value", _DBL)),
    "orders_per_day": _s(("purchase_date", _DATE), ("order_count", _LNG)),
    "order_status_breakdown": _s(("order_status", _STR), ("order_count", _LNG)),
    "revenue_by_state": _s(("customer_state", _STR), ("revenue", _DBL)),
    "orders_by_state": _s(("customer_state", _STR), ("order_count", _LNG)),
    "avg_order_value_by_state": _s(("customer_state", _STR), ("avg_order_value", _DBL)),
    "top_cities_by_revenue": _s(("customer_city", _STR), ("revenue", _DBL)),
    "revenue_by_category": _s(("product_category_name", _STR), ("revenue", _DBL)),
    "top_products": _s(("product_id", _STR), ("revenue", _DBL)),
    "top_sellers": _s(("seller_id", _STR), ("revenue", _DBL)),
    "freight_vs_price_by_category": _s(("product_category_name", _STR), ("avg_price", _DBL),
                                       ("avg_freight", _DBL)),
    "orders_by_payment_type": _s(("payment_type", _STR), ("order_count", _LNG)),
    "revenue_by_payment_type": _s(("payment_type", _STR), ("revenue", _DBL)),
    "installments_distribution": _s(("payment_installments", _DBL), ("count", _LNG)),
    "avg_payment_by_type": _s(("payment_type", _STR), ("avg_payment_value", _DBL)),
    "review_distribution": _s(("review_sentiment", _STR), ("count", _LNG)),
    "review_score_distribution": _s(("review_score", _DBL), ("count", _LNG)),
    "review_score_by_state": _s(("customer_state", _STR), ("avg_review_score", _DBL)),
    "review_score_by_category": _s(("product_category_name", _STR), ("avg_review_score", _DBL)),
    "late_delivery_by_state": _s(("customer_state", _STR), ("total_rows", _LNG), ("late_rows", _LNG),
                                 ("unique_orders", _LNG), ("late_delivery_rate", _DBL)),
    "on_time_vs_late_delivery": _s(("delivery_status", _STR), ("count", _LNG)),
    "average_delay_by_state": _s(("customer_state", _STR), ("avg_delay_days", _DBL)),
    "delay_trend_over_time": _s(("purchase_date", _DATE), ("avg_delay_days", _DBL)),
    "delay_vs_review_score": _s(("review_score", _DBL), ("avg_delay_days", _DBL)),
    "decision_support": _s(("best_state_by_revenue", _STR), ("top_category_by_revenue", _STR),
                           ("top_payment_type", _STR), ("worst_state_by_late_rate", _STR),
                           ("positive_review_ratio", _DBL), ("negative_review_ratio", _DBL)),
}

# The tables the serving layer expects to find: every output except the order-level KPI file.
EXPECTED_OUTPUTS = sorted(set(OUTPUT_SCHEMAS) - {"kpi_summary_order_level"})
