"""Micro-batch sinks that may be repeated: two outputs of one decode, and mergeable partial state.

A micro-batch writes folders named by its id (``batch_id=N``) and replaces what
an earlier try of the same batch left there. Structured Streaming repeats a
batch under the same id with the same messages until it is committed, so
whatever the moment of a failure nothing is lost and nothing counts twice.

The state holds one row for each (state, order) and batch: exact sums and counts
that merge by addition. A *version* is the merged state of all batches up to one;
it is complete when its marker, written last, is there. Readers take the latest
complete version and the batches after it, so compaction may run at any time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlens.functions.money import money, to_cents
from orderlens.operators.marts import kpi_columns
from orderlens.plans.facts import facts_from_raw
from orderlens.streaming.codec import CORRUPT, decode, decode_all
from orderlens.streaming.ingest import _triggered

Hook = Callable[[str, int], None]
_KEYS = ["customer_state", "order_id"]
_SUMS = {
    "rows": "bigint", "late": "bigint", "score_n": "bigint", "delay": "bigint",
    "revenue": "decimal(38,4)", "score": "decimal(38,4)",
}


def _folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def run_sinks(
    messages: DataFrame,
    sink_path: str,
    reject_path: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    on_written: Hook | None = None,
) -> StreamingQuery:
    """S4 + S6: each message is decoded once; rows go to ``sink_path`` (Parquet), messages that are no rows to ``reject_path``.

    ``on_written`` is told of each sink's folder as it is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_all(batch).persist()
        try:
            decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT).write.mode("overwrite").parquet(_folder(sink_path, batch_id))
            if on_written:
                on_written("rows", batch_id)
            bad = decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
            bad.write.mode("overwrite").parquet(_folder(reject_path, batch_id))
            if on_written:
                on_written("rejects", batch_id)
        finally:
            decoded.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, processing_time).start()


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a sink of ``run_sinks``."""
    return spark.read.parquet(path).drop("batch_id")


# --------------------------------------------------------------------------
# Mergeable state
# --------------------------------------------------------------------------

def partial_state(facts: DataFrame) -> DataFrame:
    """One row for each (customer_state, order_id): what A1, A6, A7, A20, A22 and A24 add up."""
    score = money("review_score")
    sums = {
        "rows": F.count(F.lit(1)), "late": F.sum("is_late_delivery"), "score_n": F.count(score), "delay": F.sum("delivery_delay_days"),
        "revenue": F.sum(money("revenue")), "score": F.sum(score),
    }
    return facts.groupBy(*_KEYS).agg(*[sums[n].cast(t).alias(n) for n, t in _SUMS.items()])


def _merged(parts: DataFrame) -> DataFrame:
    # one shuffle, by the order: what is grouped by the order afterwards (A1) needs no second one, and batches hold a key once
    return parts.repartition("order_id").groupBy(*_KEYS).agg(*[F.sum(n).cast(t).alias(n) for n, t in _SUMS.items()])


def run_state(
    messages: DataFrame,
    state_path: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    on_written: Hook | None = None,
) -> StreamingQuery:
    """Add each micro-batch's partial state under its id; a repeated batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        state = partial_state(facts_from_raw(decode(batch)))
        state.write.mode("overwrite").option("compression", "zstd").parquet(_folder(f"{state_path}/batches", batch_id))
        if on_written:
            on_written("state", batch_id)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, processing_time).start()


def _version(spark: SparkSession, state_path: str) -> int:
    """The latest complete version, -1 if there is none."""
    try:
        found = spark.read.parquet(f"{state_path}/complete").agg(F.max("version").alias("v")).first()
    except AnalysisException:
        return -1
    return -1 if found["v"] is None else int(found["v"])


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The merged state: the latest complete version and the batches after it."""
    version = _version(spark, state_path)
    names = [*_KEYS, *_SUMS]
    parts = spark.read.parquet(f"{state_path}/batches").where(F.col("batch_id") > version).select(*names)
    if version >= 0:
        parts = parts.unionByName(spark.read.parquet(f"{state_path}/versions/version={version}").select(*names))
    return _merged(parts)


def compact(spark: SparkSession, state_path: str) -> int:
    """Merge all batches that are there into a new version; the number of the version.

    Safe beside a running stream: a batch that is written meanwhile comes after
    the version, and one that is still being repeated gives the same rows.
    """
    last = spark.read.parquet(f"{state_path}/batches").agg(F.max("batch_id").alias("b")).first()["b"]
    version = _version(spark, state_path)
    if last is None or last <= version:
        return version
    names = [*_KEYS, *_SUMS]
    parts = spark.read.parquet(f"{state_path}/batches").where((F.col("batch_id") > version) & (F.col("batch_id") <= last)).select(*names)
    if version >= 0:
        parts = parts.unionByName(spark.read.parquet(f"{state_path}/versions/version={version}").select(*names))
    _merged(parts).write.mode("overwrite").option("compression", "zstd").parquet(f"{state_path}/versions/version={last}")
    # the marker comes last
    spark.createDataFrame([(int(last),)], "version long").write.mode("append").parquet(f"{state_path}/complete")
    return int(last)


def kpi_from_state(state: DataFrame) -> DataFrame:
    """A1 from the state; an order under two states counts once."""
    per_order = state.groupBy("order_id").agg(*[F.sum(n).alias(n) for n in _SUMS])
    return per_order.agg(
        F.sum("revenue").alias("rev"), F.count("order_id").alias("orders"), F.sum("score").alias("score_sum"), F.sum("score_n").alias("score_n"),
        F.sum("late").alias("late_sum"), F.sum("rows").alias("late_n"),
    ).select(*kpi_columns())


def revenue_from_state(state: DataFrame) -> DataFrame:
    """A6 from the state."""
    by_state = state.groupBy("customer_state").agg(F.sum("revenue").alias("exact"))
    ordered = by_state.orderBy(F.col("exact").desc_nulls_last(), F.col("customer_state").asc_nulls_last())
    return ordered.select("customer_state", to_cents(F.col("exact")).alias("revenue"))
