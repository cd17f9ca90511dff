"""Joins of hot keys on (key, part).

AQE splits a skewed partition only for a join that sits directly on two
shuffles; inside a chain of co-partitioned joins (the enrichment joins on
order_id) an order with very many rows, or whose payments, reviews and items
multiply to very many, would be one task. Such orders are cut into parts:

* ``hot_keys`` counts the rows of every key in each input exactly (one
  aggregation with partial counts over the key columns) and keeps the keys
  whose *product* of counts exceeds ``rows_per_task``; a kept key gets
  ``ceil(product / rows_per_task)`` parts, at most one for each row of the input
  with most rows, which is the input to be split.
* ``parted`` gives each row of the split input one part, by a hash of the row
  and its place in the file, and repeats the rows of the other inputs for every
  part. The parts travel through the whole chain as a second join key.
* A part that drew no row of the split input would leave a row without match
  behind; ``real_rows`` drops it, which is exact because the split input has
  rows of that key, in the same query.

``hot_keys`` is part of the query itself: no sample, no cached statistics, so
the result never depends on what the files held earlier. Whether any key is
hot is asked once when the plan is built (``any_hot``): without one the plain
chain is used, which keeps its partitioning by order_id. That choice changes
the layout only; both plans give the same rows for any input.

The kept keys are broadcast: each stands for more than ``rows_per_task`` joined
rows, so there are at most (joined rows / rows_per_task) of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts over which rows without a key are spread.
NULL_PARTS = 64


@dataclass(frozen=True)
class SkewPolicy:
    rows_per_task: int = 20_000_000
    enabled: bool = True


DEFAULT_POLICY = SkewPolicy()


def hot_keys(inputs: list[DataFrame], key: str, rows_per_task: int) -> DataFrame:
    """(key, _parts, _split) of the keys whose joined rows exceed ``rows_per_task``; _split: the input to split."""
    tagged = reduce(
        DataFrame.unionByName, [df.where(F.col(key).isNotNull()).select(key, F.lit(i).alias("_input")) for i, df in enumerate(inputs)]
    )
    names = [f"_n{i}" for i in range(len(inputs))]
    counts = tagged.groupBy(key).agg(*[F.count(F.when(F.col("_input") == i, 1)).alias(n) for i, n in enumerate(names)])
    rows = reduce(lambda a, b: a * b, [F.greatest(F.col(n), F.lit(1)).cast("double") for n in names])
    most = F.greatest(*names)
    split = F.coalesce(*[F.when(F.col(n) == most, F.lit(i)) for i, n in enumerate(names)])
    return counts.where(rows > rows_per_task).select(
        key, F.least(F.ceil(rows / rows_per_task), most).cast("int").alias("_parts"), split.alias("_split")
    )


def any_hot(inputs: list[DataFrame], key: str, rows_per_task: int) -> bool:
    return not hot_keys(inputs, key, rows_per_task).isEmpty()


def parted(df: DataFrame, index: int, hot: DataFrame, key: str, keep_key_of_null: bool) -> DataFrame:
    """``df`` with its _part: one for each row of the split input, all of them for the others, 0 for other keys.

    Rows without a key match nothing: they are spread (``keep_key_of_null``) or
    dropped. ``df`` should be a scan (or a projection of one), whose rows keep
    their place when a task is repeated.
    """
    if not keep_key_of_null:
        df = df.where(F.col(key).isNotNull())
    row = F.xxhash64(*df.columns)
    # equal rows spread by their place in the file (the preserved input is left deterministic for filter pushdown)
    place = F.xxhash64(row, F.monotonically_increasing_id()) if index else row
    d = df.join(F.broadcast(hot), key, "left")
    part = (
        F.when(F.col(key).isNull(), F.array(F.pmod(row, F.lit(NULL_PARTS)).cast("int")))
        .when(F.col("_split") == index, F.array(F.pmod(place, F.col("_parts")).cast("int")))
        .when(F.col("_split").isNotNull(), F.sequence(F.lit(0), F.col("_parts") - 1))
        .otherwise(F.array(F.lit(0)))
    )
    d = d.withColumn("_part", F.explode(part))
    return d.drop("_parts") if index == 0 else d.drop("_parts", "_split").withColumn(f"_has{index}", F.lit(True))


def real_rows(joined: DataFrame, inputs: int) -> DataFrame:
    """Drop what only a part without rows of the split input made, and the helper columns."""
    spurious: Column = F.lit(False)
    for i in range(1, inputs):
        spurious = spurious | ((F.col("_split") == i) & F.col(f"_has{i}").isNull())
    kept = joined.where(~F.coalesce(spurious, F.lit(False)))
    return kept.drop("_part", "_split", *[f"_has{i}" for i in range(1, inputs)])


def dimension_join(left: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``left.join(right, key, "left")`` for a unique right key, the rows without a key spread over parts.

    They are spread by one column that the query reads anyway, so that the scans stay pruned. Both sides are
    shuffles of their own, so adaptive execution splits a hot key.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(NULL_PARTS))).otherwise(F.lit(0)).cast("int")
    l = left.withColumn("_null_part", spread)
    # always 0, but not a literal, which the planner would turn into a filter beside the join
    r = right.where(F.col(key).isNotNull()).withColumn("_null_part", F.pmod(F.xxhash64(key), F.lit(1)).cast("int"))
    return l.join(r, [key, "_null_part"], "left").drop("_null_part")
