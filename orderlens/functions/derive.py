"""Revenue, review sentiment, delivery delay, late flag, purchase date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sentiment(score: Column) -> Column:
    """null -> unknown, >=4 positive, ==3 neutral, >=1 negative, else unknown."""
    return (
        F.when(score.isNull(), "unknown")
        .when(score >= 4, "positive")
        .when(score == 3, "neutral")
        .when(score >= 1, "negative")
        .otherwise("unknown")
    )


def delay_days(delivered: Column, estimated: Column) -> Column:
    """Calendar days delivered - estimated; undelivered counts as 0."""
    return F.coalesce(F.datediff(delivered, estimated), F.lit(0))


def delivery_status(is_late: Column) -> Column:
    return F.when(is_late == 1, "late").otherwise("on_time")


def derive(df: DataFrame) -> DataFrame:
    """Add the derived fields to a cleaned frame (one projection).

    Null price and freight become 0 before anything else, so averages of
    price include the zeros of item-less orders.
    """
    price = F.coalesce(F.col("price"), F.lit(0.0))
    freight = F.coalesce(F.col("freight_value"), F.lit(0.0))
    delay = delay_days(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    others = [c for c in df.columns if c not in ("price", "freight_value")]
    return df.select(
        *others,
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).alias("revenue"),
        sentiment(F.col("review_score")).alias("review_sentiment"),
        delay.alias("delivery_delay_days"),
        (delay > 0).cast("int").alias("is_late_delivery"),
        F.to_date("order_purchase_timestamp").alias("purchase_date"),
    )
