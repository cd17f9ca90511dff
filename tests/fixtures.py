"""Hand-written source tables (all-string columns, as landed CSV)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from orderlens import schema as S
from orderlens.sources.tables import SourceTables

COLUMNS = {
    "orders": S.ORDER_COLUMNS,
    "items": ["order_id"] + S.ITEM_COLUMNS,
    "products": ["product_id"] + S.PRODUCT_COLUMNS,
    "customers": ["customer_id"] + S.CUSTOMER_COLUMNS,
    "payments": ["order_id"] + S.PAYMENT_COLUMNS,
    "reviews": ["order_id"] + S.REVIEW_COLUMNS,
}


def frame(spark: SparkSession, table: str, rows: list[dict]):
    cols = COLUMNS[table]
    data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in cols) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))


def tables(spark: SparkSession, **rows: list[dict]) -> SourceTables:
    return SourceTables(**{t: frame(spark, t, rows.get(t, [])) for t in COLUMNS})


def basic(spark: SparkSession) -> SourceTables:
    """o1: 2 items x 2 payments x 1 review; o2: no items, payment or review."""
    return tables(
        spark,
        orders=[
            dict(order_id="o1", customer_id="c1", order_status="delivered",
                 order_purchase_timestamp="2018-01-01 10:00:00",
                 order_delivered_customer_date="2018-01-12 18:00:00",
                 order_estimated_delivery_date="2018-01-11 00:00:00"),
            dict(order_id="o2", customer_id="c2", order_status="canceled",
                 order_purchase_timestamp="2018-01-02 09:00:00",
                 order_estimated_delivery_date="2018-01-20 00:00:00"),
        ],
        items=[
            dict(order_id="o1", order_item_id="1", product_id="p1", seller_id="s1", price="100.10", freight_value="10.05"),
            dict(order_id="o1", order_item_id="2", product_id="p2", seller_id="s2", price="50", freight_value="5"),
        ],
        products=[dict(product_id="p1", product_category_name="toys"), dict(product_id="p2")],
        customers=[
            dict(customer_id="c1", customer_unique_id="u1", customer_zip_code_prefix="14409.0",
                 customer_city="sao paulo", customer_state="SP"),
            dict(customer_id="c2", customer_unique_id="u2", customer_zip_code_prefix="01001",
                 customer_city="rio", customer_state="RJ"),
        ],
        payments=[
            dict(order_id="o1", payment_sequential="1", payment_type="credit_card", payment_installments="3",
                 payment_value="100"),
            dict(order_id="o1", payment_sequential="2", payment_type="voucher", payment_installments="1",
                 payment_value="65.15"),
        ],
        reviews=[dict(order_id="o1", review_id="r1", review_score="5",
                      review_answer_timestamp="2018-01-15 00:00:00")],
    )
