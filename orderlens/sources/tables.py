"""The six source tables of the order model.

A ``SourceTables`` bundle is what the enrichment joins consume. Any backend
(CSV landing files, Parquet, the test-data adapter) produces one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schema as S
from orderlens.sources.csv_format import WRITE, read_options


@dataclass(frozen=True)
class SourceTables:
    orders: DataFrame
    items: DataFrame
    products: DataFrame
    customers: DataFrame
    payments: DataFrame
    reviews: DataFrame
    # Applied to the joined rows before the 36-column projection. Adapters
    # use it for columns that depend on more than one table.
    finalize: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Landing file names and their column lists.
CSV_FILES = {
    "orders": ("olist_orders_dataset.csv", S.ORDER_COLUMNS),
    "items": ("olist_order_items_dataset.csv", ["order_id"] + S.ITEM_COLUMNS),
    "products": ("olist_products_dataset.csv", ["product_id"] + S.PRODUCT_COLUMNS),
    "customers": ("olist_customers_dataset.csv", ["customer_id"] + S.CUSTOMER_COLUMNS),
    "payments": ("olist_order_payments_dataset.csv", ["order_id"] + S.PAYMENT_COLUMNS),
    "reviews": ("olist_order_reviews_dataset.csv", ["review_id", "order_id"] + S.REVIEW_COLUMNS[1:]),
}


def read_csv_tables(spark: SparkSession, landing_dir: str, multiline: bool = True) -> SourceTables:
    """Scan the six landing CSVs with explicit all-string schemas.

    No inference pass; typing happens once, after the joins, in the cleaning
    step, so that the batch and the stream path share it. Quoted fields may
    hold newlines (review comments), hence ``multiline`` by default; a
    multi-line CSV file is read by one task, so large landings without
    embedded newlines should pass ``multiline=False`` (files then split) or
    be landed as Parquet.
    """
    frames = {}
    for name, (file_name, columns) in CSV_FILES.items():
        frames[name] = (
            spark.read.schema(_strings(*columns))
            .options(**read_options(multiline))
            .csv(f"{landing_dir.rstrip('/')}/{file_name}")
        )
    return SourceTables(**frames)


def read_snapshot(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The raw enriched snapshot (CSV written by the stream sink).

    Header, no inference (the fixed 36 string columns), quoted fields may
    span lines, malformed rows kept (PERMISSIVE) and typed later. A snapshot
    whose fields hold no newline splits into many tasks with ``multiline=False``;
    a Parquet snapshot (the default of the stream) always does.
    """
    return (
        spark.read.schema(S.RAW_SCHEMA)
        .options(**read_options(multiline))
        .csv(path)
    )


def write_csv_tables(tables: SourceTables, landing_dir: str) -> None:
    """Land the six tables as CSV folders under the landing file names."""
    for name, (file_name, columns) in CSV_FILES.items():
        df = getattr(tables, name)
        present = [c for c in columns if c in df.columns]
        (
            df.select(*present)
            .write.mode("overwrite")
            .options(**WRITE)
            .csv(f"{landing_dir.rstrip('/')}/{file_name}")
        )


def land_parquet(spark: SparkSession, landing_dir: str, out_dir: str, multiline: bool = True) -> None:
    """Land the six CSV files once as Parquet, all columns text as scanned: from then on every scan is split and pruned."""
    tables = read_csv_tables(spark, landing_dir, multiline)
    for name in CSV_FILES:
        getattr(tables, name).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")


def read_landed(spark: SparkSession, dir_: str) -> SourceTables:
    """The six tables that ``land_parquet`` wrote."""
    frames = {name: spark.read.schema(_strings(*columns)).parquet(f"{dir_.rstrip('/')}/{name}") for name, (_, columns) in CSV_FILES.items()}
    return SourceTables(**frames)


def read_translation(spark: SparkSession, path: str) -> DataFrame:
    """Category -> English name lookup (the file starts with a BOM)."""
    df = (
        spark.read.schema(_strings("product_category_name", "product_category_name_english"))
        .option("header", True)
        .csv(path)
    )
    return df.select(
        F.regexp_replace("product_category_name", "^\uFEFF", "").alias("product_category_name"),
        "product_category_name_english",
    )


def translate_categories(df: DataFrame, translation: DataFrame) -> DataFrame:
    """Add ``product_category_name_english`` (left join on the category).

    The lookup is joined without a hint: the planner broadcasts it only while
    its size is under the broadcast threshold.
    """
    lookup = translation.dropDuplicates(["product_category_name"])
    return df.join(lookup, "product_category_name", "left")
