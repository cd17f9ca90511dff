"""The registered queries of the dealt operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import ann_graph, curriculum, fim, fingerprint, html_extract, langid, minhash, prefix_trie, quality_crf, sp_encode, token_output, toxicity, warc
from orderlens.llm.scratch import bounded_batches

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(_read(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.predict(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op5_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, recall = ann_graph.audited(_read(spark, sf_dir, "embeddings"))
    return found.withColumn("audited_recall", F.lit(recall))


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix(_read(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.write_and_read(_read(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_encode.encoded_documents(_read(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_read(spark, sf_dir, "conversations"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_read(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(_read(spark, sf_dir, "pages"))


def queries() -> dict[str, Query]:
    return {
        "op1_fingerprint": op1_fingerprint,
        "op2_language": op2_language,
        "op3_quality": op3_quality,
        "op4_minhash": op4_minhash,
        "op5_embedding_graph": op5_embedding_graph,
        "op6_curriculum_mix": op6_curriculum_mix,
        "op7_html": op7_html,
        "op8_toxicity": op8_toxicity,
        "op9_token_blocks": op9_token_blocks,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_warc": op13_warc,
    }
