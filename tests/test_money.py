"""Money outside its range, non-finite values, and the modal group without a value."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from fixtures import basic
from orderlens.functions.money import money_sum
import pytest

from orderlens.operators import insights, marts
from orderlens.plans.catalog import OUTPUTS
from orderlens.plans.facts import facts_from_tables


def test_extreme_prices_never_abort(spark):
    t = basic(spark)
    prices = ["1e20", "Infinity", "-Infinity", "NaN", "99999999999999.5", "7.5"]
    extra = t.items.limit(1).select(
        *[F.explode(F.array(*[F.lit(p) for p in prices])).alias(c) if c == "price" else F.lit("0").alias(c) if c == "freight_value" else F.col(c) for c in t.items.columns]
    )
    f = facts_from_tables(dataclasses.replace(t, items=extra))
    total = f.agg(money_sum("revenue").alias("s")).first()["s"]
    # o1 has two payments: each usable price counts twice; 1e20 is no amount, the non-finite ones are null and so 0
    assert abs(float(total) - 2 * (99999999999999.5 + 7.5)) < 0.1
    assert marts.kpi_summary(f).count() == 1


def test_no_output_aborts_on_extreme_values(spark):
    t = basic(spark)
    value = F.explode(F.array(*[F.lit(v) for v in ["1e20", "-1e20", "Infinity", "NaN"]])).alias("v")
    items = t.items.limit(1).select("*", value)
    pays = t.payments.limit(1).select("*", value)
    reviews = t.reviews.limit(1).select("*", value)
    spoilt = dataclasses.replace(
        t,
        items=items.withColumns({"price": F.col("v"), "freight_value": F.col("v")}).drop("v"),
        payments=pays.withColumns({c: F.col("v") for c in ("payment_value", "payment_installments", "payment_sequential")}).drop("v"),
        reviews=reviews.withColumn("review_score", F.col("v")).drop("v"),
    )
    f = facts_from_tables(spoilt).cache()
    for fn in OUTPUTS:
        assert fn(f).collect() is not None
    assert marts.average_payment_value(f).first()[0] == 0.0
    f.unpersist()


def test_averages_leave_out_what_is_no_amount(spark):
    t = basic(spark)
    pays = t.payments.limit(1).select(
        *[F.explode(F.array(*[F.lit(p) for p in ["1e20", "10", "20"]])).alias(c) if c == "payment_value" else F.col(c) for c in t.payments.columns]
    )
    items = t.items.limit(0)
    f = facts_from_tables(dataclasses.replace(t, payments=pays, items=items, reviews=t.reviews.limit(0)))
    assert marts.average_payment_value(f).first()[0] == 15.0


def test_small_amounts_are_rounded_before_the_sum(spark):
    df = spark.range(1000).select(F.lit(0.00004).alias("a"), F.lit(0.00006).alias("b"))
    r = df.agg(money_sum("a").alias("a"), money_sum("b").alias("b")).first()
    assert float(r["a"]) == 0.0 and float(r["b"]) == 0.1


def test_null_mode_of_instalments(spark):
    f = facts_from_tables(basic(spark))
    f = f.select(*[F.lit(None).cast("double").alias(c) if c == "payment_installments" else F.col(c) for c in f.columns])
    r = insights.installments(f).first()
    assert r.mode_installments is None and r.mode_count == f.count()
    assert insights.installments(f.limit(0)).first().mode_installments == 1
