"""Q1-Q5: contract checks over an exported output folder, as Spark jobs.

* Q1/Q2 presence and emptiness of every expected table -> ok / warning / error
* Q3 freshness: latest file modification time
* Q4 required columns: header of each table against its published schema
* Q5 typing: the reload (``sources.sinks.read_table``) applies the schema

Row counts and modification times come from one scan over all exported
files, grouped by table folder via the ``_metadata`` file columns.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schema as S
from orderlens.sources.csv_format import read_options


def file_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """(table, files, bytes, data_rows, last_modified) for every exported table.

    File listing (existence, size, modification time) comes from the
    ``binaryFile`` source reading metadata only; data rows from one CSV scan
    over all tables grouped by the file's folder.
    """
    empty = spark.createDataFrame(
        [], "table string, files long, bytes long, data_rows long, last_modified timestamp"
    )
    base = out_dir.rstrip("/")
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.csv")
            .load(f"{base}/*")
            .select("path", "length", "modificationTime")
        )
    except AnalysisException:
        return empty
    table = F.element_at(F.split(F.col("path"), "/"), -2)
    files = listing.groupBy(table.alias("table")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("last_modified"),
    )
    one_col = T.StructType([T.StructField("_c0", T.StringType())])
    rows = (
        spark.read.schema(one_col)
        .options(**read_options())
        .csv(f"{base}/*/*.csv")
        .select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("table"))
        .groupBy("table")
        .agg(F.count(F.lit(1)).alias("data_rows"))
    )
    return files.join(rows, "table", "left").select(
        "table", "files", "bytes", F.coalesce("data_rows", F.lit(0)).alias("data_rows"), "last_modified"
    )


def contract_report(spark: SparkSession, out_dir: str, expected: list[str] | None = None) -> DataFrame:
    """Q1/Q2/Q3: one row per expected table with its status."""
    names = spark.createDataFrame([(n,) for n in (expected or S.EXPECTED_OUTPUTS)], "table string")
    stats = file_stats(spark, out_dir)
    joined = names.join(stats, "table", "left")
    exists = F.col("files").isNotNull()
    rows = F.coalesce(F.col("data_rows"), F.lit(0)).cast("long")
    status = F.when(~exists, "error").when(rows == 0, "warning").otherwise("ok")
    return joined.select(
        "table", exists.alias("exists"), rows.alias("row_count"), status.alias("status"), "last_modified"
    )


def contract_summary(report: DataFrame) -> DataFrame:
    """Overall status: error if any table is missing, warning if any is empty."""
    return report.agg(
        F.when(F.sum(F.when(F.col("status") == "error", 1).otherwise(0)) > 0, "error")
        .when(F.sum(F.when(F.col("status") == "warning", 1).otherwise(0)) > 0, "warning")
        .otherwise("ok")
        .alias("status"),
        F.sort_array(F.collect_list(F.when(F.col("status") == "error", F.col("table")))).alias("missing_tables"),
        F.sort_array(F.collect_list(F.when(F.col("status") == "warning", F.col("table")))).alias("empty_tables"),
        F.max("last_modified").alias("last_modified"),
    )


def column_check(spark: SparkSession, out_dir: str, expected: list[str] | None = None) -> DataFrame:
    """Q4: does each exported table carry exactly its published columns, in their order?

    One scan of the header lines of all tables. ``columns_ok`` is false if a
    column is missing, is not published, or stands elsewhere; files of a table
    that disagree count as the worst of them.
    """
    names = expected or S.EXPECTED_OUTPUTS
    want = spark.createDataFrame(
        [(n, [f.name for f in S.OUTPUT_SCHEMAS[n].fields]) for n in names], "table string, want array<string>"
    )
    try:
        lines = spark.read.text(f"{out_dir.rstrip('/')}/*/*.csv")
    except AnalysisException:
        lines = spark.createDataFrame([], "value string").withColumn("_path", F.lit(None).cast("string"))
    else:
        lines = lines.withColumn("_path", F.col("_metadata.file_path")).where(F.col("_metadata.file_block_start") == 0)
    # a header is the first line of its file; published column names hold no comma, quote or newline
    number = F.monotonically_increasing_id()
    heads = lines.withColumn("_at", number).groupBy("_path").agg(F.min_by("value", "_at").alias("_head"))
    got = heads.select(F.element_at(F.split("_path", "/"), -2).alias("table"), F.split(F.regexp_replace("_head", '"', ""), ",").alias("got"))
    joined = want.join(got, "table", "left")
    missing = F.array_except("want", F.coalesce("got", F.array().cast("array<string>")))
    extra = F.array_except(F.coalesce("got", F.array().cast("array<string>")), "want")
    each = joined.select("table", F.coalesce(F.col("got") == F.col("want"), F.lit(False)).alias("ok"), missing.alias("m"), extra.alias("e"))
    return each.groupBy("table").agg(
        F.min("ok").alias("columns_ok"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("m")))).alias("missing_columns"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("e")))).alias("extra_columns"),
    )
