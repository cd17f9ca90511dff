"""The corpus pipeline: documents to token ids in a fixed order of stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all its predecessor
kept. All but the last return the columns of ``documents``; the last returns
the token ids. Filtering stages drop only what they reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import curriculum, langid, minhash, quality_crf, sp_encode
from orderlens.llm.scratch import bounded_batches, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    bounded_batches(spark)
    return quality_crf.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a clear language go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, sorted by training position."""
    return curriculum.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the stream."""
    return sp_encode.encoded_documents(docs)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Trained models and whole-text similarity are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read by the next stage."""
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
