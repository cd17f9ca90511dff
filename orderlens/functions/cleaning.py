"""Null normalisation, typing and null fills.

One projection, chosen per column from the input schema: typed sources pass
through (no-op casts fold away), string sources (the stream, landing CSVs)
are parsed with ``try_*`` functions so malformed values become null instead
of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schema as S

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Text that stands for "no value" on the wire (a JSON NaN may
# arrive bare or quoted; an empty field is what the landing CSV holds).
NULL_TOKENS = ["", "NaN", '"NaN"']


def _blank_to_null(c: Column) -> Column:
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def _finite(c: Column) -> Column:
    """NaN and the infinities are no values."""
    return F.when(F.abs(c) < float("inf"), c)


def parse_timestamp(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        c = _blank_to_null(c)
        return F.coalesce(F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT)), c.try_cast("timestamp"))
    if isinstance(dtype, T.TimestampType):
        return c
    return c.try_cast("timestamp")


def parse_double(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        c = _blank_to_null(c)
    if not isinstance(dtype, T.DoubleType):
        c = c.try_cast("double")
    return _finite(c)


def parse_int(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.IntegerType):
        return c
    if isinstance(dtype, T.StringType):
        # '14409.0' is not an integer literal; go through double first
        return _blank_to_null(c).try_cast("double").try_cast("int")
    return c.try_cast("int")


def parse_string(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return _blank_to_null(c)
    return c.cast("string")


def clean_column(name: str, dtype: T.DataType | None) -> Column:
    """Typed, null-normalised and filled expression for one enriched column."""
    if dtype is None:  # absent input column: typed null, the guard of the reference
        c = F.lit(None).cast(S.column_type(name))
    else:
        c = F.col(name)
        if name in S.TIMESTAMP_COLUMNS:
            c = parse_timestamp(c, dtype)
        elif name in S.DOUBLE_COLUMNS:
            c = parse_double(c, dtype)
        elif name in S.INT_COLUMNS:
            c = parse_int(c, dtype)
        elif name in S.KEY_COLUMNS and not isinstance(dtype, T.StringType):
            pass  # numeric keys stay numeric
        else:
            c = parse_string(c, dtype)
    if name in S.STRING_FILLS:
        c = F.coalesce(c, F.lit(S.STRING_FILLS[name]))
    return c.alias(name)


def clean(df: DataFrame, keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto the 36 typed enriched columns (missing ones null)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [clean_column(name, types.get(name)) for name in S.ENRICHED_COLUMNS]
    if keep_extra:
        cols += [F.col(n) for n in df.columns if n not in S.ENRICHED_COLUMNS]
    return df.select(*cols)
