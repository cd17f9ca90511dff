"""Mixing sources to target weights along a time-varying curriculum (operator 6).

Every source has a weight; shares are capped at a number of passes over the
source and the excess is shared out again by weight. A source's schedule gives
its relative weight over training time (piecewise linear on [0, 1], with the
mean 1). Its integral is the cumulative demand; inverting it at the cumulative
words before a document gives the document's training position, and documents
are range-sorted by position. The order inside a source is a fixed hash order,
so reruns agree.

Only (id, size, source) is shuffled, never a text unless it is asked for.
Running sums go in two levels, over hash buckets and inside each bucket, so a
source with a third of all rows is many tasks; the number of buckets follows
the rows and does not change the result.

Results in odd cases. Null or empty text: size 0, taken 0, no position. A null
source is a source of its own, last in order. Repeated rows count each. Null
ids are ordered first among equal hashes. An empty table gives no rows. Extra
columns are kept if ``keep`` asks for them (their names must not begin with
``_mix``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.scratch import table

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: The schedule of each weight class as (time, relative weight) knots: heavy sources lead, light ones come late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)), ((0.0, 0.75), (0.5, 1.5), (1.0, 0.25)))
ROWS_PER_BUCKET = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def invert(demand: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the integral of the schedule reaches ``demand`` (a share of its whole)."""
    area = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    whole, done, out = math.fsum(area), 0.0, None
    for ((t0, w0), (t1, w1)), a in zip(zip(knots, knots[1:], strict=False), area, strict=True):
        rest, slope = demand * whole - done, (w1 - w0) / (t1 - t0)
        if slope:
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
            at = F.lit(t0) + (root - w0) / slope
        else:
            at = F.lit(t0) + rest / w0
        at = F.least(F.greatest(at, F.lit(t0)), F.lit(t1))
        out = at if out is None else F.when(rest > 0, at).otherwise(out)
        done += a
    return out


def targets(sources: DataFrame, share: float = 1.5, passes: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds _mix_class, _mix_target to (source, _mix_size): ``share`` of all words dealt by weight, capped at ``passes``.

    The repeated resharing of the excess ends at the level where every source
    gets min(cap, level * weight); sources fill up in the order of cap / weight.
    """
    by_name = Window.orderBy(F.col("_mix_source").isNull(), F.col("_mix_source"))
    s = sources.withColumn("_mix_class", (F.row_number().over(by_name) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_mix_class") + 1)
    s = s.withColumns({"_w": weight, "_cap": F.col("_mix_size") * float(passes)})
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_mix_source").isNull(), F.col("_mix_source"))
    every = Window.partitionBy()
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumns(
        {
            "_budget": F.sum("_mix_size").over(every) * float(share),
            "_full": F.coalesce(F.sum("_cap").over(below), F.lit(0.0)),
            "_open": F.sum("_w").over(here),
        }
    )
    # the level if this source and all later ones stay open
    s = s.withColumn("_level", (F.col("_budget") - F.col("_full")) / F.col("_open"))
    s = s.withColumn("_fits", F.col("_cap") <= F.col("_level") * F.col("_w"))
    s = s.withColumn("_final", F.min(F.when(~F.col("_fits"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(every)["_level"])
    target = F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_final") * F.col("_w")))
    return s.withColumn("_mix_target", target).select("_mix_source", "_mix_size", "_mix_class", "_mix_target")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: list[str] | None = None,
    share: float = 1.5,
    passes: int = 2,
    weights: tuple[int, ...] = WEIGHTS,
    schedules: tuple = SCHEDULES,
) -> DataFrame:
    """One row per document: its size, its source's size and target, the words taken, its position in each pass.

    Adds ``size``, ``source_size``, ``target``, ``taken`` and ``positions`` (one
    per pass that takes of the document, in [0, 1]) to (id, *keep), with the
    names _mix_size, ... when ``keep`` is given.
    """
    cols = keep or []
    d = docs.select(
        F.col(id_col).alias("_mix_id"),
        F.col(source_col).alias("_mix_source"),
        word_count(F.col(text_col)).alias("_mix_words"),
        F.xxhash64(F.col(text_col)).alias("_mix_text"),
        *[F.col(c) for c in cols],
    )
    d = d.withColumn("_mix_order", F.xxhash64(F.coalesce(F.col("_mix_id").cast("string"), F.lit("")), F.lit(6)))
    if not cols:  # the words are counted once; rows to keep are not written again
        d = table(d, "mix-sizes")
    slim = d.select("_mix_source", "_mix_words", "_mix_order")
    n = slim.count()
    bits = max(0, math.ceil(math.log2(max(1, n / ROWS_PER_BUCKET)))) + 6
    bucket = F.shiftright(F.col("_mix_order"), 64 - bits)
    d = d.withColumn("_mix_bucket", bucket)
    sums = table(
        slim.withColumn("_mix_bucket", bucket).groupBy("_mix_source", "_mix_bucket").agg(F.sum("_mix_words").alias("_b")), "bucket-words"
    )
    goal = table(targets(sums.groupBy("_mix_source").agg(F.sum("_b").alias("_mix_size")), share, passes, weights), "targets")
    before = Window.partitionBy("_mix_source").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = sums.withColumn("_before", F.coalesce(F.sum("_b").over(before), F.lit(0)))
    plan = plan.join(goal.withColumnRenamed("_mix_source", "_s"), F.col("_mix_source").eqNullSafe(F.col("_s"))).select(
        F.col("_mix_source").alias("_s"), F.col("_mix_bucket").alias("_bk"), "_before", "_mix_size", "_mix_class", "_mix_target"
    )
    plan = table(plan, "mix-plan")
    inside = (
        Window.partitionBy("_mix_source", "_mix_bucket")
        # rows that repeat an id differ in their texts; what is equal in all of these may change places
        .orderBy("_mix_order", F.col("_mix_id").asc_nulls_first(), "_mix_text", "_mix_words")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    d = d.withColumn("_mix_at", F.coalesce(F.sum("_mix_words").over(inside), F.lit(0)))
    d = d.join(plan, F.col("_mix_source").eqNullSafe(F.col("_s")) & (F.col("_mix_bucket") == F.col("_bk")))
    d = d.withColumn("_mix_at", F.col("_mix_at") + F.col("_before"))
    whole = F.floor(F.col("_mix_target") + 0.5)
    parts, places = [], []
    for k in range(passes):
        start = F.col("_mix_at") + F.col("_mix_size") * k
        part = F.least(F.greatest(whole - start, F.lit(0)), F.col("_mix_words"))
        at = None
        for c, knots in enumerate(schedules):
            here = invert(start / F.greatest(F.col("_mix_target"), F.lit(1.0)), knots)
            at = here if at is None else F.when(F.col("_mix_class") % len(schedules) == c, here).otherwise(at)
        parts.append(part)
        places.append(F.when(part > 0, at))
    taken = parts[0]
    for p in parts[1:]:
        taken = taken + p
    d = d.withColumns({"_mix_taken": taken.cast("long"), "_mix_positions": F.filter(F.array(*places), lambda x: x.isNotNull())})
    out = d.select("_mix_id", "_mix_words", "_mix_size", "_mix_target", "_mix_taken", "_mix_positions", *cols)
    if keep:
        return out
    out = out.toDF(id_col, "size", "source_size", "target", "taken", "positions")
    return out.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), id_col) if n else out


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The training stream: every document as often as the mix takes it (to the nearest whole copy), sorted by position."""
    m = mix(docs, id_col, text_col, source_col, keep=docs.columns)
    copies = F.round(F.col("_mix_taken") / F.greatest(F.col("_mix_words"), F.lit(1))).cast("int")
    m = m.withColumn("_mix_position", F.explode(F.slice("_mix_positions", F.lit(1), copies)))
    return m.orderBy("_mix_position", "_mix_id").select(*docs.columns)
