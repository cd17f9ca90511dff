"""The five left joins that build the enriched (joined-row) record.

Reference semantics: orders LEFT JOIN items ON order_id, LEFT JOIN products ON
product_id, LEFT JOIN customers ON customer_id, LEFT JOIN payments ON
order_id, LEFT JOIN reviews ON order_id. The grain is order x item x payment
x review: payments and reviews multiply rows.

Plan shape (same result, rearranged for scale):

* The N:1 dimension joins run first, on the smaller inputs:
  items LEFT JOIN products, orders LEFT JOIN customers (left joins are
  associative here because every later predicate rejects nulls of its own
  left side).
* Everything else joins on order_id: the order side (orders + customers,
  payments, reviews) and then the items, as one co-partitioned chain. Each
  input is hash-partitioned on order_id once, the fanned-out rows are never
  re-shuffled, and aggregations grouped by (anything, order_id) downstream
  need no further exchange.
* Orders with more joined rows than one task should process are cut into parts
  that run through the whole chain (``operators/skew.py``); where no order is
  that large the chain is the plain one. Rows without a product or customer are
  spread around the dimension joins.

No broadcast hints: the planner broadcasts a side only when its statistics are
under spark.sql.autoBroadcastJoinThreshold, and AQE re-plans from actual
shuffle sizes; larger sides stay sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.operators.skew import DEFAULT_POLICY, SkewPolicy, any_hot, dimension_join, hot_keys, parted, real_rows
from orderlens.sources.tables import SourceTables


def enrich(t: SourceTables, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    sides = [t.orders, t.payments, t.reviews, t.items]
    on = ["order_id"]
    split = policy.enabled and any_hot(sides, "order_id", policy.rows_per_task)
    if split:
        hot = hot_keys(sides, "order_id", policy.rows_per_task)
        sides = [parted(df, i, hot, "order_id", keep_key_of_null=i == 0) for i, df in enumerate(sides)]
        on = ["order_id", "_part"]
    orders, payments, reviews, items = sides
    items = dimension_join(items, t.products, "product_id", spread_by="order_id")
    orders = dimension_join(orders, t.customers, "customer_id", spread_by="order_id")
    joined = orders.join(payments, on, "left").join(reviews, on, "left").join(items, on, "left")
    if split:
        joined = real_rows(joined, len(sides))
    joined = t.finalize(joined)
    present = set(joined.columns)
    return joined.select(*[F.col(c) if c in present else F.lit(None).alias(c) for c in S.ENRICHED_COLUMNS])
