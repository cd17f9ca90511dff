"""The snapshot as a date-partitioned table: date filters prune folders, date bounds come from file footers.

``write_snapshot`` lays joined rows out by purchase month; a month of any size is
split into files by a rebalance, so a hot month is no single task. Rows without a
purchase date form a partition of their own, which no date filter reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "purchase_month"


def write_snapshot(facts: DataFrame, path: str) -> None:
    """Write ``facts`` (with purchase_date) as Parquet, partitioned by purchase month and sorted by date inside files."""
    rows = facts.withColumn(MONTH, F.year("purchase_date") * 100 + F.month("purchase_date"))
    rows = rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "purchase_date")
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def read_dates(spark: SparkSession, path: str, start: dt.date | str | None = None, end: dt.date | str | None = None) -> DataFrame:
    """P10 over a written snapshot: rows with start <= purchase_date <= end, other months never listed as input.

    Without a bound on a side that side is open; without any the whole snapshot, undated rows too.
    """
    rows = spark.read.parquet(path)
    for bound, is_start in ((start, True), (end, False)):
        if bound is None:
            continue
        day = dt.date.fromisoformat(bound) if isinstance(bound, str) else bound
        month, date = F.lit(day.year * 100 + day.month), F.lit(day)
        rows = rows.where((F.col(MONTH) >= month) & (F.col("purchase_date") >= date) if is_start else (F.col(MONTH) <= month) & (F.col("purchase_date") <= date))
    return rows.drop(MONTH)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer min, max and count from file footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    other.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_bounds(spark: SparkSession, path: str) -> DataFrame:
    """(lo, hi): first and last purchase date of a written snapshot, from the footers of its files.

    The partition of undated rows is left out: its files have no least and no greatest date.
    """
    dated = footer_session(spark).read.parquet(path).where(F.col(MONTH).isNotNull())
    return dated.agg(F.min("purchase_date").alias("lo"), F.max("purchase_date").alias("hi"))
