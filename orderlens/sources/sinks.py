"""Export of the published tables and their typed reload."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schema as S
from orderlens.sources.csv_format import WRITE, read_options


def export_table(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = True) -> None:
    """Write one published table (overwrite).

    Published tables are aggregates bounded by their group count, so one file
    each (``coalesce(1)`` keeps the sorted order of a sorted frame). Never use
    ``single_file`` for row-level frames.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**WRITE)
    writer.save(path)


def export_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "csv") -> list[str]:
    written = []
    for name, df in tables.items():
        export_table(df, f"{out_dir.rstrip('/')}/{name}", fmt)
        written.append(name)
    return written


def read_table(spark: SparkSession, out_dir: str, name: str, fmt: str = "csv") -> DataFrame:
    """Reload one table with its published schema; missing -> empty frame.

    Columns are taken by the name in the file's header, whatever their order;
    one that the file lacks is null, one that is not published is left out.
    Values are cast with ``try_cast``: what does not parse is null.
    """
    schema = S.OUTPUT_SCHEMAS[name]
    path = f"{out_dir.rstrip('/')}/{name}"
    try:
        if fmt == "csv":
            found = spark.read.options(**read_options()).csv(path)
        else:
            found = spark.read.format(fmt).load(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return found.select(*[_typed(found, f).alias(f.name) for f in schema.fields])


def _typed(found: DataFrame, field: T.StructField):
    if field.name not in found.columns:
        return F.lit(None).cast(field.dataType)
    return F.col(f"`{field.name}`").try_cast(field.dataType)


def reload_rejects(spark: SparkSession, out_dir: str, names: list[str] | None = None) -> DataFrame:
    """(table, column, values, rejected): for each published column how many values it holds, and how many of them don't parse.

    One scan a table, driven by its published schema: a value is rejected where
    the reload's ``try_cast`` makes null of it. A column that a file lacks has no
    values; a missing table has no rows.
    """
    parts = []
    for name in names or S.EXPECTED_OUTPUTS:
        try:
            found = spark.read.options(**read_options()).csv(f"{out_dir.rstrip('/')}/{name}")
        except AnalysisException:
            continue
        counts = []
        for f in S.OUTPUT_SCHEMAS[name].fields:
            raw = F.col(f"`{f.name}`") if f.name in found.columns else F.lit(None).cast("string")
            bad = raw.isNotNull() & _typed(found, f).isNull()
            counts.append(F.struct(F.lit(f.name).alias("column"), F.count(raw).alias("values"), F.count(F.when(bad, 1)).alias("rejected")))
        parts.append(found.agg(F.array(*counts).alias("_c")).select(F.lit(name).alias("table"), F.inline("_c")))
    if not parts:
        return spark.createDataFrame([], "`table` string, `column` string, values long, rejected long")
    return reduce(DataFrame.unionByName, parts)


def read_tables(spark: SparkSession, out_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {n: read_table(spark, out_dir, n) for n in (names or S.EXPECTED_OUTPUTS)}
