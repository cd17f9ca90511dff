"""Parted joins give exactly the plain result and leave no large partition."""

from __future__ import annotations

import contextlib
import dataclasses

import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from fixtures import basic
from orderlens.operators.enrich import enrich
from orderlens.operators.skew import SkewPolicy, dimension_join, hot_keys
from orderlens.plans.facts import facts_from_tables
from orderlens.sources.testdata import load_testdata

OFF = SkewPolicy(enabled=False)
TARGET = 1_000


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _small(spark, **extra):
    """The hand-written tables with more rows of some of them, appended."""
    t = basic(spark)
    changed = {}
    for name, make in extra.items():
        old = getattr(t, name)
        new = make(spark)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema.fields if f.name not in new.columns]
        new = new.select("*", *missing).select(*[F.col(f.name).cast(f.dataType) for f in old.schema.fields])
        changed[name] = old.unionByName(new)
    return dataclasses.replace(t, **changed)


def _largest(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@contextlib.contextmanager
def shuffled(spark, partitions):
    """Joins as on large data: shuffles only, each partition a task."""
    conf = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def hot_payments(spark):
    return _small(spark, payments=lambda s: s.range(20_000).select(F.lit("o1").alias("order_id"), F.col("id").alias("payment_sequential")))


def equal_payments(spark):
    return _small(spark, payments=lambda s: s.range(0, 20_000, 1, 4).select(F.lit("o1").alias("order_id"), F.lit("voucher").alias("payment_type")))


def hot_reviews(spark):
    return _small(spark, reviews=lambda s: s.range(20_000).select(F.lit("o1").alias("order_id"), F.col("id").cast("string").alias("review_id")))


def product_of_two(spark):
    return _small(
        spark,
        payments=lambda s: s.range(200).select(F.lit("o1").alias("order_id"), F.col("id").alias("payment_sequential")),
        items=lambda s: s.range(200).select(F.lit("o1").alias("order_id"), F.col("id").alias("order_item_id")),
    )


@pytest.mark.parametrize("make", [hot_payments, equal_payments, hot_reviews, product_of_two])
def test_hot_orders_are_split_exactly(spark, make):
    t = make(spark)
    plain, parts = enrich(t, OFF), enrich(t, SkewPolicy(rows_per_task=TARGET))
    assert _rows(plain) == _rows(parts)
    with shuffled(spark, 64):
        assert _largest(enrich(t, OFF)) > 15_000
        assert _largest(enrich(t, SkewPolicy(rows_per_task=TARGET))) < 8 * TARGET


def test_rows_without_keys_are_spread(spark):
    t = _small(
        spark,
        items=lambda s: s.range(20_000).select(F.concat(F.lit("x"), F.col("id")).alias("order_id"), F.col("id").alias("order_item_id")),
    )
    with shuffled(spark, 64):
        joined = dimension_join(t.items, t.products, "product_id", spread_by="order_id")
        assert joined.count() == t.items.count()
        assert _largest(joined) < 5_000


def test_every_order_may_be_hot(spark):
    t = load_testdata(spark, SF_SMALL)
    assert _rows(facts_from_tables(t, OFF)) == _rows(facts_from_tables(t, SkewPolicy(rows_per_task=1)))


def test_no_order_is_lost_when_files_change(spark, tmp_path):
    """Hot orders of an earlier state of the files say nothing about the next one."""
    path = str(tmp_path / "payments")
    policy = SkewPolicy(rows_per_task=2)
    base = basic(spark)
    many = spark.range(5).select(F.lit("o1").alias("order_id"), F.col("id").cast("double").alias("payment_sequential"))
    many.write.parquet(path)

    def tables():
        p = spark.read.parquet(path)
        fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in base.payments.schema.fields if f.name not in p.columns]
        return dataclasses.replace(base, payments=p.select("*", *fill))

    enrich(tables(), policy).count()
    many.where("false").unionByName(many.limit(1).withColumn("order_id", F.lit("o2"))).write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    got = {r.order_id for r in enrich(tables(), policy).select("order_id").collect()}
    assert got == {r.order_id for r in base.orders.select("order_id").collect()}


def test_hot_keys_sizes(spark):
    t = product_of_two(spark)
    hot = hot_keys([t.orders, t.payments, t.reviews, t.items], "order_id", TARGET).collect()
    assert len(hot) == 1 and hot[0]["_parts"] >= 40 and hot[0]["_split"] in (1, 3)
    assert hot_keys([t.orders, t.payments, t.reviews, t.items], "order_id", 20_000_000).count() == 0
