"""The published aggregates without the fan-out: sums pushed below the joins that multiply rows.

A row of the facts is order x item x payment x review. Every published measure
is a sum (or a count, or a distinct count of orders) of a value that belongs to
one of the four, so it needs of the other three only *how many* rows an order
has: with ``I`` lines, ``P`` payments and ``R`` reviews of an order (an empty
side counts as one row without values, as the left joins give),

* a sum over lines weighs each line by P * R, over payments each payment by
  I * R, over reviews each review by I * P;
* the counts come from one aggregation of the keys of all four inputs
  (``order_counts``): one exchange, combined on the map side, whatever an order
  holds.

So the joined rows number the lines, an order's payments and reviews never
multiply, and a hot order costs its own rows instead of their product.

``revenue_by`` answers one output straight from the tables. ``order_grain``
writes, for the refresh, the lines (with the weights) and the *order-grain
table*, one row for each order and its attributes, bucketed by order_id, so that
no distinct count of orders is exchanged by order afterwards; ``measures`` are the
frames that the outputs in ``marts`` project. ``decision_sets`` collapses each
order to its distinct (state, category), payment types and sentiments before it
expands them to the four grouping sets.

All results equal those over the facts to the bit: money is exact DECIMAL, the
weights are integers. ``SourceTables.finalize`` may use columns of orders, items,
products and customers, and may not change money, payments or reviews.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.functions.cleaning import clean, clean_column
from orderlens.functions.derive import derive, delivery_status, sentiment
from orderlens.functions.money import MONEY, money
from orderlens.operators.marts import kpi_columns
from orderlens.operators.skew import dimension_join
from orderlens.session import run_folder, staged
from orderlens.sources.tables import SourceTables

KEY = "order_id"


def _cleaned(df: DataFrame, *names: str) -> list[Column]:
    """The typed, filled expressions of some enriched columns of a source table (null or the fill where it lacks one)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [clean_column(n, types.get(n)) for n in names]


def _revenue(items: DataFrame) -> Column:
    price, freight = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("price", "freight_value"))
    return money(price + freight)


def _item_rows(t: SourceTables, *dims: str) -> DataFrame:
    """(order_id, dims, revenue) of the items, cleaned."""
    rows = t.items.select(F.col(KEY), *_cleaned(t.items, "price", "freight_value", *dims))
    return rows.select(KEY, *dims, _revenue(rows).alias("revenue"))


def order_counts(t: SourceTables, revenue: bool = False) -> DataFrame:
    """(order_id, o, p, r, i[, revenue]) of every order id of ``orders``: rows in each input, and the items' revenue.

    One aggregation over the keys of the four inputs: a hot order is combined where it is read.
    """
    sides = [(t.orders, "o"), (t.payments, "p"), (t.reviews, "r")]
    sides = [(df.select(KEY), tag) for df, tag in sides] + [(_item_rows(t) if revenue else t.items.select(KEY), "i")]
    tagged = []
    for df, tag in sides:
        value = F.col("revenue") if revenue and tag == "i" else F.lit(None).cast(MONEY)
        tagged.append(df.where(F.col(KEY).isNotNull()).select(KEY, F.lit(tag).alias("_tag"), *([value.alias("revenue")] if revenue else [])))
    counts = [F.count(F.when(F.col("_tag") == tag, 1)).alias(tag) for _, tag in sides]
    sums = [F.sum("revenue").alias("revenue")] if revenue else []
    return reduce(DataFrame.unionByName, tagged).groupBy(KEY).agg(*counts, *sums).where("o > 0")


def _least_one(c: str) -> Column:
    return F.greatest(F.col(c), F.lit(1))


def _sum_weighted(value: Column | str, weight: Column) -> Column:
    return F.sum(value * weight if isinstance(value, Column) else F.col(value) * weight)


# --------------------------------------------------------------------------
# One output: revenue by a dimension
# --------------------------------------------------------------------------

ITEM_DIMENSIONS = ("product_id", "seller_id", "product_category_name")
ORDER_DIMENSIONS = ("customer_state", "customer_city")
_ZERO = "cast(0 as decimal(18,4))"


def revenue_by(t: SourceTables, key: str) -> DataFrame:
    """(key, revenue_exact): the revenue of the joined rows, by a dimension of the items, the customer or the payment."""
    if key in ITEM_DIMENSIONS:
        return _by_item(t, key)
    if key in ORDER_DIMENSIONS:
        return _by_customer(t, key)
    if key == "payment_type":
        return _by_payment(t, key)
    raise ValueError(f"no dimension of revenue: {key}")


def _by_item(t: SourceTables, key: str) -> DataFrame:
    counts = order_counts(t)
    raw = "product_id" if key == "product_category_name" else key
    rows = t.items.select(KEY, raw, *_cleaned(t.items, "price", "freight_value"))
    rows = rows.select(KEY, raw, _revenue(rows).alias("revenue"))
    weight = F.col("o") * _least_one("p") * _least_one("r")
    real = rows.join(counts.select(KEY, weight.alias("_w")), KEY)
    real = real.groupBy(raw).agg(_sum_weighted("revenue", F.col("_w")).alias("revenue"))
    if key == "product_category_name":  # one row a product by now
        real = real.join(t.products.select("product_id", key), "product_id", "left")
    real = real.select(*_cleaned(real, key), "revenue")
    fill = F.lit(S.STRING_FILLS[key]).alias(key)
    without = counts.where("i = 0").select(fill, F.expr(_ZERO).alias("revenue"))
    keyless = t.orders.where(F.col(KEY).isNull()).select(fill, F.expr(_ZERO).alias("revenue"))
    return real.unionByName(without).unionByName(keyless).groupBy(key).agg(F.sum("revenue").alias("revenue_exact"))


def _by_customer(t: SourceTables, key: str) -> DataFrame:
    counts = order_counts(t, revenue=True)
    # of an order with items the sum (null if none of its values is an amount), of one without items 0
    per_order = F.when(F.coalesce(F.col("i"), F.lit(0)) == 0, F.expr(_ZERO)).otherwise(F.col("revenue"))
    weight = F.coalesce(_least_one("p") * _least_one("r"), F.lit(1))
    orders = t.orders.select(KEY, "customer_id").join(counts.drop("o"), KEY, "left")
    orders = orders.groupBy("customer_id").agg(_sum_weighted(per_order, weight).alias("revenue"))
    named = orders.join(t.customers.select("customer_id", key), "customer_id", "left")  # one row a customer by now
    return named.select(*_cleaned(named, key), "revenue").groupBy(key).agg(F.sum("revenue").alias("revenue_exact"))


def _by_payment(t: SourceTables, key: str) -> DataFrame:
    counts = order_counts(t, revenue=True)
    per_order = F.when(F.col("i") == 0, F.expr(_ZERO)).otherwise(F.col("revenue")) * F.col("o") * _least_one("r")
    counts = counts.select(KEY, "p", per_order.alias("revenue"))
    types = t.payments.select(KEY, *_cleaned(t.payments, key)).groupBy(KEY, key).agg(F.count(F.lit(1)).alias("_k"))
    real = types.join(counts.drop("p"), KEY).select(key, (F.col("revenue") * F.col("_k")).alias("revenue"))
    fill = F.lit(S.STRING_FILLS[key]).alias(key)
    without = counts.where("p = 0").select(fill, "revenue")
    keyless = t.orders.where(F.col(KEY).isNull()).select(fill, F.expr(_ZERO).alias("revenue"))
    return real.unionByName(without).unionByName(keyless).groupBy(key).agg(F.sum("revenue").alias("revenue_exact"))


# --------------------------------------------------------------------------
# The refresh: lines, order-grain table, measures
# --------------------------------------------------------------------------

#: Columns of a line that any output reads; the order-grain table groups by the first ones.
ATTRIBUTES = ["customer_state", "customer_city", "order_status", "purchase_date"]
LINE_VALUES = ["product_id", "seller_id", "product_category_name", "price", "freight_value", "revenue", "delivery_delay_days", "is_late_delivery"]
LINE_ORDER = ["order_purchase_timestamp", "order_item_id", "order_delivered_customer_date"]
REVIEW_ORDER = ["review_answer_timestamp", "review_id"]
_SIDE = ["_p", "_r", "_score_sum", "_score_n", "_payment", "_review"]


def _sides(t: SourceTables) -> DataFrame:
    """(order_id, _p, _r, _score_sum, _score_n, _payment, _review): an order's payments and reviews, and the last of each."""
    payment = ["payment_sequential", "payment_type", "payment_installments", "payment_value"]
    p = t.payments.where(F.col(KEY).isNotNull()).select(KEY, *_cleaned(t.payments, *payment)).groupBy(KEY)
    p = p.agg(F.count(F.lit(1)).alias("_p"), F.max(F.struct(*payment)).alias("_payment"))
    review = [*REVIEW_ORDER, "review_score"]
    r = t.reviews.where(F.col(KEY).isNotNull()).select(KEY, *_cleaned(t.reviews, *review)).groupBy(KEY)
    score = money("review_score")
    r = r.agg(F.count(F.lit(1)).alias("_r"), F.sum(score).alias("_score_sum"), F.count(score).alias("_score_n"), F.max(F.struct(*review)).alias("_review"))
    return p.join(r, KEY, "full")


def _order_items(t: SourceTables, orders: DataFrame, items: DataFrame) -> DataFrame:
    """``orders`` left join ``items``, finalized, with the raw order id as _key.

    An inner join, whose sides adaptive execution may split, and the orders without items beside it.
    """
    has = t.items.where(F.col(KEY).isNotNull()).select(KEY).distinct()
    both = orders.join(items, KEY).unionByName(orders.join(has, KEY, "left_anti"), allowMissingColumns=True)
    return t.finalize(both).withColumn("_key", F.col(KEY))


def lines(t: SourceTables) -> DataFrame:
    """One row for each order and item (or order without items), with the weights of the other sides."""
    orders = dimension_join(t.orders, t.customers, "customer_id", spread_by=KEY).join(_sides(t), KEY, "left")
    items = dimension_join(t.items, t.products, "product_id", spread_by=KEY)
    joined = _order_items(t, orders, items)
    typed = derive(clean(joined.drop("payment_sequential", "payment_type", "payment_installments", "payment_value"), keep_extra=True))
    ones = {c: F.coalesce(F.col(c), F.lit(1)) for c in ("_p", "_r")}
    wanted = [KEY, *ATTRIBUTES, *LINE_ORDER, *[c for c in LINE_VALUES if c != "revenue"]]
    return typed.select("_key", *wanted, money("revenue").alias("revenue"), *[ones.get(c, F.col(c)).alias(c) for c in _SIDE])


@dataclass
class OrderGrain:
    """The tables of a refresh: lines, orders (bucketed by order_id), and the source's payments and reviews."""

    lines: DataFrame
    orders: DataFrame
    payments: DataFrame
    reviews: DataFrame
    name: str

    def drop(self) -> None:
        self.orders.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def order_grain(t: SourceTables, buckets: int | None = None) -> OrderGrain:
    """Write the lines and the order-grain table into the shared folder."""
    spark = t.orders.sparkSession
    rows = staged(lines(t), "lines")
    per_order = rows.groupBy("_key", KEY, *ATTRIBUTES).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("revenue").alias("revenue"),
        F.sum("is_late_delivery").cast("long").alias("late"),
        F.sum("delivery_delay_days").cast("long").alias("delay"),
        F.max(F.struct(*LINE_ORDER, "is_late_delivery")).alias("_line"),
        *[F.max(c).alias(c) for c in _SIDE],
    )
    name = f"orderlens_orders_{uuid.uuid4().hex[:12]}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_order.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", run_folder(spark, "order-grain")).saveAsTable(name)
    payments = t.payments.where(F.col(KEY).isNotNull()).select(F.col(KEY).alias("_key"), *_cleaned(t.payments, "payment_type", "payment_installments", "payment_value"))
    reviews = t.reviews.where(F.col(KEY).isNotNull()).select(F.col(KEY).alias("_key"), *_cleaned(t.reviews, "review_score"))
    return OrderGrain(rows, spark.table(name), payments, reviews, name)


def _w() -> Column:
    return F.col("_p") * F.col("_r")


def kpi_summary(g: OrderGrain) -> DataFrame:
    """A1 from the order-grain table."""
    return g.orders.agg(
        _sum_weighted("revenue", _w()).alias("rev"),
        F.countDistinct(KEY).alias("orders"),
        _sum_weighted("_score_sum", F.col("n") * F.col("_p")).alias("score_sum"),
        F.sum(F.coalesce("_score_n", F.lit(0)) * F.col("n") * F.col("_p")).alias("score_n"),
        _sum_weighted("late", _w()).alias("late_sum"),
        F.sum(F.col("n") * _w()).alias("late_n"),
    ).select(*kpi_columns())


def order_level(g: OrderGrain) -> DataFrame:
    """A27 from the order-grain table: the last line, review and payment of each order, and its revenue.

    The representative row is the greatest by keys that belong to one side each,
    so it is made of the greatest of each side.
    """
    per_order = g.orders.groupBy(KEY).agg(
        F.max("_line").alias("_line"), F.max("_review").alias("_review"), F.max("_payment").alias("_payment"), _sum_weighted("revenue", _w()).alias("order_revenue_exact")
    )
    return per_order.select(KEY, "_line.*", "_review.*", "_payment.payment_sequential", "order_revenue_exact")


def kpi_summary_order_level(g: OrderGrain) -> DataFrame:
    """A2 from the order-grain table."""
    score = money("review_score")
    agg = order_level(g).where(F.col(KEY).isNotNull()).agg(
        F.sum("order_revenue_exact").alias("rev"),
        F.count(F.lit(1)).alias("orders"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_n"),
        F.sum("is_late_delivery").cast("long").alias("late_sum"),
        F.count("is_late_delivery").alias("late_n"),
    )
    return agg.select(*kpi_columns())


def state_measures(g: OrderGrain) -> DataFrame:
    return g.orders.groupBy("customer_state").agg(
        F.sum(F.col("n") * _w()).alias("total_rows"),
        F.sum(F.col("late") * _w()).alias("late_rows"),
        F.countDistinct(KEY).alias("unique_orders"),
        _sum_weighted("revenue", _w()).alias("revenue_exact"),
        _sum_weighted("_score_sum", F.col("n") * F.col("_p")).alias("score_sum"),
        F.sum(F.coalesce("_score_n", F.lit(0)) * F.col("n") * F.col("_p")).alias("score_n"),
        F.sum(F.col("delay") * _w()).alias("delay_sum"),
        F.sum(F.col("n") * _w()).alias("delay_n"),
    )


def aov_measures(g: OrderGrain) -> DataFrame:
    per_order = g.orders.where(F.col(KEY).isNotNull()).groupBy("customer_state", KEY).agg(_sum_weighted("revenue", _w()).alias("_revenue"))
    return per_order.groupBy("customer_state").agg(F.sum("_revenue").alias("aov_sum"), F.count(F.lit(1)).alias("aov_n"))


def city_measures(g: OrderGrain) -> DataFrame:
    return g.orders.groupBy("customer_city").agg(_sum_weighted("revenue", _w()).alias("revenue_exact"))


def status_measures(g: OrderGrain) -> DataFrame:
    return g.orders.groupBy("order_status").agg(F.countDistinct(KEY).alias("order_count"))


def date_measures(g: OrderGrain) -> DataFrame:
    return g.orders.where(F.col("purchase_date").isNotNull()).groupBy("purchase_date").agg(
        F.countDistinct(KEY).alias("order_count"), F.sum(F.col("delay") * _w()).alias("delay_sum"), F.sum(F.col("n") * _w()).alias("delay_n")
    )


def delivery_measures(g: OrderGrain) -> DataFrame:
    """Rows late and on time; a side without rows is no group."""
    both = g.orders.agg(F.sum(F.col("late") * _w()).alias("late"), F.sum((F.col("n") - F.col("late")) * _w()).alias("on_time"))
    sides = [F.struct(delivery_status(F.lit(k)).alias("delivery_status"), F.col(c).alias("count")) for k, c in ((1, "late"), (0, "on_time"))]
    return both.select(F.inline(F.array(*sides))).where(F.col("count") > 0)


def category_measures(g: OrderGrain) -> DataFrame:
    price, freight = money("price"), money("freight_value")
    return g.lines.groupBy("product_category_name").agg(
        _sum_weighted("revenue", _w()).alias("revenue_exact"),
        _sum_weighted(price, _w()).alias("price_sum"),
        F.sum(F.when(price.isNotNull(), _w()).otherwise(0)).alias("price_n"),
        _sum_weighted(freight, _w()).alias("freight_sum"),
        F.sum(F.when(freight.isNotNull(), _w()).otherwise(0)).alias("freight_n"),
        _sum_weighted("_score_sum", F.col("_p")).alias("score_sum"),
        F.sum(F.coalesce("_score_n", F.lit(0)) * F.col("_p")).alias("score_n"),
    )


def line_revenue(g: OrderGrain, key: str) -> DataFrame:
    return g.lines.groupBy(key).agg(_sum_weighted("revenue", _w()).alias("revenue_exact"))


def _by_key(g: OrderGrain) -> DataFrame:
    """An order's lines, revenue and delay, and its other sides' rows."""
    return g.orders.groupBy("_key", KEY).agg(
        F.sum("n").alias("n"), F.sum("revenue").alias("revenue"), F.sum("delay").alias("delay"), F.max("_p").alias("_p"), F.max("_r").alias("_r"),
        F.max(F.col("_payment").isNotNull()).alias("_paid"), F.max(F.col("_review").isNotNull()).alias("_reviewed"),
    )


def payment_rows(g: OrderGrain) -> DataFrame:
    """(payment_type, payment_installments, order_id, k, value, value_n, n, revenue, _r): the payments of each order, or one without values."""
    value = money("payment_value")
    own = g.payments.groupBy("_key", "payment_type", "payment_installments").agg(F.count(F.lit(1)).alias("k"), F.sum(value).alias("value"), F.count(value).alias("value_n"))
    orders = _by_key(g)
    names = ["payment_type", "payment_installments", KEY, "k", "value", "value_n", "n", "revenue", "_r"]
    none = orders.where("not _paid").select(
        F.lit(S.STRING_FILLS["payment_type"]).alias("payment_type"), F.lit(None).cast("double").alias("payment_installments"), KEY, F.lit(1).cast("long").alias("k"),
        F.lit(None).cast("decimal(28,4)").alias("value"), F.lit(0).cast("long").alias("value_n"), "n", "revenue", "_r",
    )
    # rows without an order id, all in one group, are paid by nothing: each is one payment row of its own
    return own.join(orders.where("_paid"), "_key").select(*names).unionByName(none)


def payment_measures(rows: DataFrame) -> DataFrame:
    weight = F.col("n") * F.col("_r")
    return rows.groupBy("payment_type").agg(
        F.countDistinct(KEY).alias("order_count"),
        _sum_weighted("revenue", F.col("k") * F.col("_r")).alias("revenue_exact"),
        _sum_weighted("value", weight).alias("payment_sum"),
        F.sum(F.col("value_n") * weight).alias("payment_n"),
    )


def installment_measures(rows: DataFrame) -> DataFrame:
    return rows.groupBy("payment_installments").agg(F.sum(F.col("k") * F.col("n") * F.col("_r")).alias("count"))


def payment_total(rows: DataFrame) -> DataFrame:
    weight = F.col("n") * F.col("_r")
    return rows.agg(_sum_weighted("value", weight).alias("payment_sum"), F.sum(F.col("value_n") * weight).alias("payment_n"))


def score_measures(g: OrderGrain) -> DataFrame:
    own = g.reviews.groupBy("_key", "review_score").agg(F.count(F.lit(1)).alias("k"))
    orders = _by_key(g)
    none = orders.where("not _reviewed").select(F.lit(None).cast("double").alias("review_score"), F.lit(1).cast("long").alias("k"), "n", "delay", "_p")
    rows = own.join(orders.where("_reviewed"), "_key").select("review_score", "k", "n", "delay", "_p").unionByName(none)
    return rows.groupBy("review_score").agg(
        F.sum(F.col("k") * F.col("n") * F.col("_p")).alias("count"),
        F.sum(F.col("delay") * F.col("k") * F.col("_p")).alias("delay_sum"),
        F.sum(F.col("k") * F.col("n") * F.col("_p")).alias("delay_n"),
    )


def sentiment_measures(scores: DataFrame) -> DataFrame:
    return scores.groupBy(sentiment(F.col("review_score")).alias("review_sentiment")).agg(F.sum("count").alias("count"))


# --------------------------------------------------------------------------
# Decision support: grouping sets in two phases
# --------------------------------------------------------------------------

def decision_sets(t: SourceTables) -> DataFrame:
    """(tag, key, rev, rows, late, orders) of the four leaders' dimensions, for ``marts``.

    First phase: each order is collapsed to its distinct (state, category), its
    payment types and its sentiments, all aggregated by order. Second phase: one
    row a member of a set is generated from each collapsed order and aggregated
    by (tag, key). No row of one side is ever paired with rows of another.
    """
    orders = dimension_join(t.orders, t.customers.select("customer_id", "customer_state"), "customer_id", spread_by=KEY)
    items = dimension_join(t.items, t.products.select("product_id", "product_category_name"), "product_id", spread_by=KEY)
    typed = derive(clean(_order_items(t, orders, items), keep_extra=True))
    cells = typed.groupBy("_key", KEY, "customer_state", "product_category_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("revenue")).cast("decimal(38,4)").alias("rev"), F.sum("is_late_delivery").cast("long").alias("late")
    )
    cell = F.struct(F.col("customer_state").alias("state"), F.col("product_category_name").alias("category"), "n", "rev", "late")
    per_order = cells.groupBy("_key", KEY).agg(F.collect_list(cell).alias("cells"), F.sum("n").alias("i"))

    def side(df: DataFrame, value: Column, name: str) -> DataFrame:
        counted = df.where(F.col(KEY).isNotNull()).select(F.col(KEY).alias("_key"), value.alias("v")).groupBy("_key", "v").agg(F.count(F.lit(1)).alias("k"))
        return counted.groupBy("_key").agg(F.collect_list(F.struct("v", "k")).alias(name), F.sum("k").alias(f"{name}_n"))

    pays = side(t.payments, _cleaned(t.payments, "payment_type")[0], "p")
    scored = t.reviews.select(KEY, *_cleaned(t.reviews, "review_score"))
    reviews = side(scored, sentiment(F.col("review_score")), "r")
    whole = per_order.join(pays, "_key", "left").join(reviews, "_key", "left")

    def alone(v: str) -> Column:
        return F.array(F.struct(F.lit(v).alias("v"), F.lit(1).cast("long").alias("k")))

    whole = whole.select(
        KEY, "cells", "i", F.coalesce("p", alone(S.STRING_FILLS["payment_type"])).alias("p"), F.coalesce("r", alone("unknown")).alias("r"),
        F.coalesce("p_n", F.lit(1)).alias("p_n"), F.coalesce("r_n", F.lit(1)).alias("r_n"),
    )
    weight = F.col("p_n") * F.col("r_n")
    none = F.lit(None)

    def row(tag: str, key: Column, rev: Column = none, rows: Column = none, late: Column = none, orders_: Column = none) -> Column:
        return F.struct(
            F.lit(tag).alias("tag"), key.alias("key"), rev.cast("decimal(38,4)").alias("rev"), rows.cast("long").alias("rows"),
            late.cast("long").alias("late"), orders_.cast("long").alias("orders"),
        )

    members = F.concat(
        F.transform("cells", lambda c: row("state", c["state"], c["rev"] * weight, c["n"] * weight, c["late"] * weight)),
        F.transform("cells", lambda c: row("category", c["category"], c["rev"] * weight)),
        F.transform("p", lambda p: row("payment", p["v"], orders_=F.when(F.col(KEY).isNotNull(), 1).otherwise(0))),
        F.transform("r", lambda r: row("sentiment", r["v"], rows=r["k"] * F.col("i") * F.col("p_n"))),
    )
    rows = whole.select(F.inline(members))
    return rows.groupBy("tag", "key").agg(*[F.sum(c).alias(c) for c in ("rev", "rows", "late", "orders")])
