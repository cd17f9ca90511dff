"""Published tables in versioned folders, with a manifest that is committed last.

Every publication writes its tables under a folder of its own. Row counts are
observed while the tables are written, so nothing is read back; when all tables
are there, one manifest row a table commits the version. Readers use the latest
committed version; a folder without a manifest is a publication that broke off,
which ``manifest_report`` names, and never hides the version before it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens import schema as S
from orderlens.sources.sinks import export_table, read_table

_MANIFEST = "version string, `table` string, data_rows long, columns array<string>, written_at timestamp"


def publish_tables(tables: dict[str, DataFrame], out_dir: str, threads: int = 8, commit: bool = True) -> str:
    """Write ``tables`` as a new version and commit it; the version's name.

    ``commit=False`` leaves the manifest out, as a publication that breaks off does.
    """
    base = out_dir.rstrip("/")
    now = dt.datetime.now(dt.timezone.utc)
    version = f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:6]}"
    counts: dict[str, Observation] = {}

    def write(name: str) -> None:
        counts[name] = Observation(f"{name}-{version}")
        export_table(tables[name].observe(counts[name], F.count(F.lit(1)).alias("n")), f"{base}/versions/{version}/{name}")

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        list(pool.map(write, tables))
    if commit and tables:
        spark = next(iter(tables.values())).sparkSession
        rows = [(version, name, int(counts[name].get["n"] or 0), df.columns, now) for name, df in tables.items()]
        # appended in one file: the version is committed as a whole
        spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return version


def manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows of all committed versions."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{out_dir.rstrip('/')}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], _MANIFEST)


def _latest(rows: DataFrame) -> DataFrame:
    """The rows of the latest version; names ascend with time."""
    last = rows.agg(F.max("version").alias("version"))
    return rows.join(F.broadcast(last), "version")  # one row


def broken_versions(spark: SparkSession, out_dir: str) -> DataFrame:
    """(version) of the publications that were never committed, from the listing of files alone."""
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out_dir.rstrip('/')}/versions").select("path")
    except AnalysisException:
        return spark.createDataFrame([], "version string")
    version = F.regexp_extract("path", r"/versions/([^/]+)/", 1).alias("version")
    return listing.select(version).distinct().join(manifest(spark, out_dir).select("version").distinct(), "version", "left_anti")


def manifest_report(spark: SparkSession, out_dir: str, expected: list[str] | None = None) -> DataFrame:
    """Q1-Q4 without reading a row: one row an expected table of the latest committed version.

    (table, exists, row_count, status, columns_ok, last_modified, broken): status
    as in ``contracts.contract_report``; broken: publications that broke off.
    """
    names = expected or S.EXPECTED_OUTPUTS
    want = spark.createDataFrame([(n, [f.name for f in S.OUTPUT_SCHEMAS[n].fields]) for n in names], "`table` string, want array<string>")
    joined = want.join(_latest(manifest(spark, out_dir)), "table", "left")
    exists, rows = F.col("version").isNotNull(), F.coalesce("data_rows", F.lit(0))
    status = F.when(~exists, "error").when(rows == 0, "warning").otherwise("ok")
    broken = broken_versions(spark, out_dir).agg(F.count(F.lit(1)).alias("broken"))
    report = joined.select(
        "table", exists.alias("exists"), rows.cast("long").alias("row_count"), status.alias("status"),
        F.coalesce(F.col("columns") == F.col("want"), F.lit(False)).alias("columns_ok"), F.col("written_at").alias("last_modified"), F.lit(1).alias("_one"),
    )
    return report.join(F.broadcast(broken.withColumn("_one", F.lit(1))), "_one").drop("_one")  # one row


def read_published(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """S10 from the latest committed version; a table it lacks is an empty typed frame."""
    last = manifest(spark, out_dir).agg(F.max("version").alias("v")).first()["v"]
    if last is None:
        return spark.createDataFrame([], S.OUTPUT_SCHEMAS[name])
    return read_table(spark, f"{out_dir.rstrip('/')}/versions/{last}", name)
