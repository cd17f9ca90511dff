"""The enriched row as a keyed JSON message, and back.

Encoding keeps the producer's conventions: key = order_id as a string, value
= one JSON object of the 36 columns, timestamps as 'yyyy-MM-dd HH:mm:ss',
null fields omitted. Decoding projects any message onto the fixed 36-column
string schema: unknown keys are dropped, missing keys are null. Typing and
the NaN / empty-string normalisation (S5) happen in the shared cleaning step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schema as S

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss", "ignoreNullFields": "true"}


def encode(df: DataFrame, key_col: str = "order_id") -> DataFrame:
    """Rows -> (key string, value JSON string)."""
    cols = [c for c in S.ENRICHED_COLUMNS if c in df.columns]
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*cols), JSON_OPTIONS).alias("value"),
    )


CORRUPT = "_corrupt"
_WITH_CORRUPT = T.StructType([*S.RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])


def decode_all(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """(value bytes or string) -> the 36 raw string columns and the message itself where it is not a JSON object."""
    value = F.col(value_col).cast("string")
    options = {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = messages.select(F.from_json(value, _WITH_CORRUPT, options).alias("m"), value.alias("_value"))
    bad = F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull() | ~F.coalesce(F.ltrim("_value").startswith("{"), F.lit(False))
    return parsed.select(*[F.col(f"m.{f.name}") for f in S.RAW_SCHEMA.fields], F.when(bad, F.coalesce("_value", F.lit(""))).alias(CORRUPT))


def decode(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """(value bytes or string) -> the 36 raw string columns of the well-formed messages."""
    return decode_all(messages, value_col).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejects(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """The messages that ``decode`` leaves out, as one text column."""
    return decode_all(messages, value_col).where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def publish(df: DataFrame, fmt: str = "kafka", path: str | None = None, options: dict | None = None, append: bool = False) -> None:
    """S2 sink: write the encoded rows once (batch).

    ``fmt="kafka"`` needs the Kafka connector and ``kafka.bootstrap.servers``
    / ``topic`` options; ``fmt="text"`` writes JSON lines (the value column)
    to ``path``, one file per partition, for file-based pipelines and tests;
    publishing again replaces what an earlier run left there, unless it is to
    ``append``. ``options`` pass through (``compression`` for text).
    """
    out = encode(df)
    if fmt == "text":
        out.select("value").write.mode("append" if append else "overwrite").options(**(options or {})).text(path)
        return
    writer = out.write.format(fmt).options(**(options or {}))
    writer.save(path) if path else writer.save()
