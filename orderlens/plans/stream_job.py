"""The publish -> ingest -> aggregate round trip, as one job.

Encodes the enriched rows as JSON-lines messages into a landing folder,
ingests them with a checkpointed stream into a Parquet snapshot, and returns
an aggregate computed from the snapshot. The folders live under the shared
checkpoint directory (a fresh run folder per call).

Disk. The messages are some 27 times the tables they are made of, so a large
input is published in waves, by a hash of the order: a wave is joined, landed
(gzip) and ingested before the next one, and the stream deletes landed files
once their batch is committed. At any time the folders hold the snapshot, two
waves of messages at most and the shuffle files of one; every wave scans the
tables again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import marts
from orderlens.plans.facts import enriched, facts_from_raw, facts_from_tables
from orderlens.sources.tables import read_csv_tables, read_snapshot, write_csv_tables
from orderlens.sources.testdata import files_now, load_testdata
from orderlens.session import run_folder, shuffles_dropped
from orderlens.streaming import encode, publish, read_stream, run_append
from orderlens.streaming.batches import compact, read_sink, read_state, run_sinks, run_state

#: A wave for so many bytes of the order tables, but not more waves than this.
WAVE_BYTES, MOST_WAVES = 64 << 20, 10


def waves_of(spark: SparkSession, sf_dir: str) -> int:
    size = sum(length for _, length, _ in files_now(spark, sf_dir))
    return min(MOST_WAVES, 1 + size // WAVE_BYTES)


def in_waves(rows: DataFrame, landing: str, waves: int, ingest: Callable[[DataFrame], None]) -> None:
    """Publish ``rows`` into ``landing`` in ``waves`` by order and ``ingest`` the stream of each, before the next one lands."""
    spark = rows.sparkSession
    with shuffles_dropped(spark):
        for k in range(waves):
            # the filter reaches the scans of all tables that join on the order; orders without an id are in one wave
            wave = rows.where(F.pmod(F.xxhash64("order_id"), F.lit(waves)) == k) if waves > 1 else rows
            publish(wave, fmt="text", path=landing, options={"compression": "gzip"}, append=True)
            ingest(read_stream(spark, fmt="text", path=landing, options={"cleanSource": "delete"}))


def ingest_roundtrip(spark: SparkSession, sf_dir: str, aggregate=marts.late_delivery_by_state) -> DataFrame:
    base = run_folder(spark, "stream")
    landing, sink, chk = f"{base}/landing", f"{base}/snapshot", f"{base}/checkpoint"

    def ingest(stream: DataFrame) -> None:
        run_append(stream, sink, chk, options={"compression": "zstd"}).awaitTermination()

    in_waves(enriched(spark, sf_dir), landing, waves_of(spark, sf_dir), ingest)
    snapshot = spark.read.parquet(sink)
    return aggregate(facts_from_raw(snapshot))


def csv_snapshot_roundtrip(spark: SparkSession, sf_dir: str, aggregate=marts.avg_payment_by_type) -> DataFrame:
    """Stream the messages into a CSV snapshot (the reference's landing file),
    read it back with the snapshot scan (S8) and aggregate."""
    base = run_folder(spark, "snapshot")
    landing, sink, chk = f"{base}/landing", f"{base}/snapshot", f"{base}/checkpoint"

    def ingest(stream: DataFrame) -> None:
        run_append(stream, sink, chk, fmt="csv", options={"compression": "gzip"}).awaitTermination()

    in_waves(enriched(spark, sf_dir), landing, waves_of(spark, sf_dir), ingest)
    return aggregate(facts_from_raw(read_snapshot(spark, sink)))


def awkward_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts (quotes, commas, newlines, outer blanks) as comments through publish, the CSV sink and the snapshot scan."""
    base = run_folder(spark, "awkward")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(
        F.col("doc_id").alias("order_id"), F.col("text").alias("review_comment_message"), F.col("lang").alias("customer_city")
    )
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").where(F.col("text").isNotNull()).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("order_id"), F.col("text").alias("review_comment_message"), F.col("role").alias("customer_city")
    )
    publish(docs.unionByName(turns), fmt="text", path=f"{base}/landing")
    run_append(read_stream(spark, fmt="text", path=f"{base}/landing"), f"{base}/snapshot", f"{base}/checkpoint", fmt="csv").awaitTermination()
    back = read_snapshot(spark, f"{base}/snapshot")
    return back.select(
        F.col("order_id").cast("long").alias("doc_id"), F.col("review_comment_message").alias("text"), F.col("customer_city").alias("lang")
    )


class _Interrupted(RuntimeError):
    """Stands for a lost driver in the registered queries."""


def _until_done(start, attempts: int = 3) -> None:
    """Run a stream to its end, starting it again when it is interrupted."""
    for left in range(attempts - 1, -1, -1):
        try:
            start().awaitTermination()
            return
        except StreamingQueryException as e:
            if not left or "Interrupted" not in str(e):
                raise


def _interrupt_once(kind: str, batch_id: int):
    """A hook that breaks a stream off right after ``kind`` of one batch was written, before the batch is committed."""
    told = []

    def hook(what: str, batch: int) -> None:
        if what == kind and batch == batch_id and not told:
            told.append(batch)
            raise _Interrupted("Interrupted after a write")

    return hook


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth order's message is cut off: good and rejected messages, counted in the two sinks of one stream that broke off between them."""
    base = run_folder(spark, "rejects")
    orders = load_testdata(spark, sf_dir).orders
    messages = encode(orders)
    cut = F.expr("substring(value, 1, length(value) - 1)")
    broken = messages.select(F.when(F.col("key").cast("long") % 5 == 0, cut).otherwise(F.col("value")).alias("value"))
    broken.write.text(f"{base}/landing")
    stream = read_stream(spark, fmt="text", path=f"{base}/landing")
    hook = _interrupt_once("rows", 0)
    _until_done(lambda: run_sinks(stream, f"{base}/rows", f"{base}/rejected", f"{base}/checkpoint", on_written=hook))
    good = read_sink(spark, f"{base}/rows").agg(F.count(F.lit(1)).alias("messages")).select(F.lit("good").alias("kind"), "messages")
    bad = read_sink(spark, f"{base}/rejected").agg(F.count(F.lit(1)).alias("messages")).select(F.lit("rejected").alias("kind"), "messages")
    return good.unionByName(bad)


def streamed_state(spark: SparkSession, sf_dir: str, batches: int = 5) -> DataFrame:
    """The merged state of the enriched messages, streamed in ``batches`` micro-batches or more, one for each wave.

    One batch is repeated after its state was written but not committed, and the
    state is compacted on the way.
    """
    base = run_folder(spark, "state")
    hook = _interrupt_once("state", 2)

    def ingest(stream: DataFrame) -> None:
        def start():
            return run_state(stream, f"{base}/state", f"{base}/checkpoint", on_written=hook)

        try:
            start().awaitTermination()
        except StreamingQueryException as e:
            if "Interrupted" not in str(e):
                raise
            compact(spark, f"{base}/state")  # with a batch in it that is about to be repeated
            _until_done(start)

    in_waves(enriched(spark, sf_dir), f"{base}/landing", max(batches, waves_of(spark, sf_dir)), ingest)
    return read_state(spark, f"{base}/state")


def landing_csv_roundtrip(spark: SparkSession, sf_dir: str, aggregate=marts.revenue_by_category) -> DataFrame:
    """Land the six source tables as CSV, scan them back (S1) and aggregate."""
    landing = run_folder(spark, "landing")
    write_csv_tables(load_testdata(spark, sf_dir), landing)
    tables = read_csv_tables(spark, landing)
    return aggregate(facts_from_tables(tables))
