"""Adapter from the driver's TPC-H-style tables to the six order tables.

The mapping is fixed by FIXTURES.md section 4; the same expressions appear in
the DuckDB oracle SQL. Synthetic columns exist to exercise operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.tables import SourceTables

_TS = "timestamp"


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(ts: Column, n: int) -> Column:
    return ts + F.make_interval(days=F.lit(n))


_LOADED: dict[tuple, tuple[tuple, SourceTables]] = {}
TABLES = ("orders", "lineitem", "part", "customer", "nation")


def files_now(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of the files of the order tables in ``sf_dir``: changes when a table is written anew."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for name in TABLES:
        path = fs_path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):  # the files of a folder, or the file itself
            found += [(str(x.getPath()), x.getLen(), x.getModificationTime()) for x in fs.listStatus(path)]
    return tuple(found)


def load_testdata(spark: SparkSession, sf_dir: str) -> SourceTables:
    """The six tables over ``sf_dir``; built once per session and directory while its files stay the same.

    The frames are lazy plans, so reusing them only saves footer reads and
    analysis; nothing is cached.
    """
    # the model's timestamps are UTC wall-clock times (the reference pins UTC)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key, now = (spark.sparkContext.applicationId, sf_dir.rstrip("/")), files_now(spark, sf_dir)
    if key not in _LOADED or _LOADED[key][0] != now:
        _LOADED[key] = (now, _build(spark, sf_dir))
    return _LOADED[key][1]


def _build(spark: SparkSession, sf_dir: str) -> SourceTables:
    orders_raw = _read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    purchase = F.col("o_orderdate").cast(_TS)

    orders = orders_raw.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        _null(_TS).alias("order_approved_at"),
        _null(_TS).alias("order_delivered_carrier_date"),
        _days(purchase, 30).alias("order_estimated_delivery_date"),
    )

    items = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("double").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        _null(_TS).alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        # price and tax carry two decimals, so the product is exact in
        # DECIMAL(., 4): equal to round(price * tax, 4) without a per-row
        # BigDecimal round of a double
        (F.col("l_extendedprice").cast("decimal(15,2)") * F.col("l_tax").cast("decimal(4,2)"))
        .cast("double")
        .alias("freight_value"),
        # carried to the finalize step: delivery depends on the order status
        F.col("l_shipdate").cast(_TS).alias("_item_shipped_at"),
    )

    products = _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") % 17 == 0, _null("string")).otherwise(F.col("p_brand")).alias(
            "product_category_name"
        ),
        *[
            _null("double").alias(c)
            for c in (
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            )
        ],
    )

    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = (
        _read(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").cast("string").alias("customer_unique_id"),
            _null("int").alias("customer_zip_code_prefix"),
            F.concat_ws("/", "n_name", "c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )

    # Payments: one row per order except every 101st; a voucher row for every
    # 10th order that has a first row. Generated per order, no shuffle.
    first_payment = F.struct(
        F.lit(1.0).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (1 + key % 12).cast("double").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )
    voucher = F.struct(
        F.lit(2.0).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit(1.0).alias("payment_installments"),
        F.lit(25.0).alias("payment_value"),
    )
    payments = (
        orders_raw.where(key % 101 != 0)
        .select(
            key.alias("order_id"),
            F.when(key % 10 == 0, F.array(first_payment, voucher)).otherwise(F.array(first_payment)).alias("p"),
        )
        .select("order_id", F.inline("p"))
    )

    def review(n: int, score: Column, answer_days: int) -> Column:
        return F.struct(
            F.concat(F.lit("r"), key.cast("string"), F.lit(f"-{n}")).alias("review_id"),
            score.cast("double").alias("review_score"),
            _null("string").alias("review_comment_title"),
            _null("string").alias("review_comment_message"),
            _null(_TS).alias("review_creation_date"),
            _days(purchase, answer_days).alias("review_answer_timestamp"),
        )

    first_review = review(1, 1 + key % 5, 40)
    second_review = review(2, 1 + (key + 2) % 5, 45)
    reviews = (
        orders_raw.where(key % 7 != 0)
        .select(
            key.alias("order_id"),
            F.when(key % 50 == 1, F.array(first_review, second_review))
            .otherwise(F.array(first_review))
            .alias("r"),
        )
        .select("order_id", F.inline("r"))
    )

    def finalize(df: DataFrame) -> DataFrame:
        delivered = F.when(F.col("order_status") == "O", _null(_TS)).otherwise(F.col("_item_shipped_at"))
        return df.withColumn("order_delivered_customer_date", delivered).drop("_item_shipped_at")

    return SourceTables(orders, items, products, customers, payments, reviews, finalize)
