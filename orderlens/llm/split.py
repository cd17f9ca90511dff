"""Held-out split and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def held_out(id_col: str, modulus: int, out: int) -> Column:
    return remainder(id_col, modulus) == out


def sample_by_class(df: DataFrame, id_col: str, class_col: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class, chosen by a hash of the id (all rows of a smaller class).

    The counts of the classes (one row each) are broadcast, so nothing is
    collected and a hot class is thinned out where it is read.
    """
    counts = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return df.join(F.broadcast(counts), class_col).where(share * F.col("_rows") < per_class).drop("_rows")


def rows_per_sampled(df: DataFrame, sample: DataFrame, class_col: str) -> dict:
    """For each class of ``sample`` how many rows of ``df`` one of its rows stands for; one row a class reaches the driver."""

    def counts(x: DataFrame) -> dict:
        return {r[class_col]: r["_rows"] for r in x.groupBy(class_col).agg(F.count(F.lit(1)).alias("_rows")).collect()}

    every = counts(df)
    return {c: every[c] / n for c, n in counts(sample).items()}
