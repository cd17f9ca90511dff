"""Tables that cut lineage, kept in the folder all executors share.

The folder is the session's ``spark.checkpoint.dir``. Where that is unset (a
local test session) a temporary folder is set as the checkpoint folder first.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder; a temporary one only where the session names none."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    own = getattr(sc, "_orderlens_scratch", None)
    if own is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="orderlens-scratch-")
        sc._orderlens_scratch = own
    return own


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "1m") -> None:
    """Bound the batches that go to Python by bytes, not by rows alone, unless the session says how large they are."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, size)


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
