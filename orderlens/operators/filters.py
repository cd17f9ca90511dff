"""The view-layer operators (date range, bounds, wildcard equality,
projection with re-sort), as DataFrame transformations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"
# Fixed value: start of the default date range when no data is present.
DEFAULT_START = dt.date(2016, 1, 1)


def date_range(df: DataFrame, start: dt.date | str, end: dt.date | str, col: str = "purchase_date") -> DataFrame:
    """P10: inclusive range filter; pushed down to the scan when ``df`` is one."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def date_bounds(daily: DataFrame, col: str = "purchase_date") -> DataFrame:
    """Min / max date with defaults (2016-01-01, today), swapped if reversed."""
    agg = daily.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    lo = F.coalesce(F.col("_lo"), F.lit(DEFAULT_START))
    hi = F.coalesce(F.col("_hi"), F.current_date())
    return agg.select(F.least(lo, hi).alias("date_start"), F.greatest(lo, hi).alias("date_end"))


def equals_or_all(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """Equality filter where "All" (or None) keeps every row."""
    if value is None or value == ALL:
        return df
    return df.where(F.col(col) == F.lit(value))


def project_sorted(df: DataFrame, cols: list[str], by: str | Column, ascending: bool = False) -> DataFrame:
    """Projection plus re-sort on one column (ties by the first column)."""
    key = F.col(by) if isinstance(by, str) else by
    order = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return df.select(*cols).orderBy(order, F.col(cols[0]).asc_nulls_last())
