"""Stream source and the checkpointed append sink.

The reference polls a topic and appends one CSV line per message, without a
checkpoint (a replay duplicates rows). Here the source is a Structured
Streaming reader (Kafka, or a folder of JSON-lines files), and the sink is a
file sink with a checkpoint: each micro-batch is committed exactly once, and
a restart with the same checkpoint resumes after the last committed offsets.
The snapshot keeps the raw string columns; the batch aggregates read it
through the same cleaning step as every other input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from orderlens.sources.csv_format import WRITE
from orderlens.streaming.codec import decode, rejects

#: Files (offsets for Kafka) of a micro-batch unless the caller says otherwise.
MAX_FILES, MAX_OFFSETS = 256, 5_000_000


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    topic: str | None = None,
    options: dict | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """S3: a streaming frame with a ``value`` column.

    ``fmt="kafka"`` subscribes to ``topic`` from the earliest offsets (extra
    ``options`` such as ``kafka.bootstrap.servers`` pass through);
    ``fmt="text"`` watches ``path`` for JSON-lines files. ``max_per_trigger``
    bounds each micro-batch (offsets for Kafka, files otherwise; MAX_OFFSETS and
    MAX_FILES by default), so a large backlog drains in several committed batches.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", topic).option("startingOffsets", "earliest")
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger or MAX_OFFSETS))
    else:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger or MAX_FILES))
    reader = reader.options(**(options or {}))
    return reader.load(path) if path else reader.load()


def run_append(
    messages: DataFrame,
    sink_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = True,
    processing_time: str | None = None,
    options: dict | None = None,
) -> StreamingQuery:
    """S4 + S6: decode each message and append the raw row to ``sink_path``.

    ``available_now`` drains what is there and stops (batch-style refresh);
    otherwise the query runs on a ``processing_time`` trigger. A message that
    is not a JSON object never becomes a row; ``run_rejects`` keeps those.
    ``options`` pass through to the sink (``compression``).
    """
    writer = decode(messages).writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "csv":
        writer = writer.options(**WRITE)
    return _triggered(writer.options(**(options or {})), available_now, processing_time).start(sink_path)


def run_rejects(
    messages: DataFrame,
    reject_path: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Append the messages that ``run_append`` leaves out, as text; their number is the folder's line count."""
    quoted = rejects(messages).select(F.to_json(F.struct("value")).alias("value"))  # one line each, newlines escaped
    writer = quoted.writeStream.format("text").outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, processing_time).start(reject_path)


def _triggered(writer: DataStreamWriter, available_now: bool, processing_time: str | None) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time) if processing_time else writer
