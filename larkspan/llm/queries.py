"""The queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.llm import blobscan, bpe, covertree, decontam, langid, linedup, orderdup, permindex, pii, quality, tokens, tput, vptree
from larkspan.llm.common import load


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(load(spark, sf_dir, "documents"), tokenizer_path())


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """spark.larkspan.ledger, if it is set, is the path of a ledger that is kept between scans."""
    return blobscan.scan_documents(load(spark, sf_dir, "documents"), spark.conf.get("spark.larkspan.ledger", None))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permindex.nearest(load(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.dedup_documents(load(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderdup.classify_documents(load(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(load(spark, sf_dir, "documents"), tokenizer_path())


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(load(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan_documents(load(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row is labelled as of the next class."""
    vectors = load(spark, sf_dir, "embeddings")
    return vptree.mine(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.link(load(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tput.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_secrets": op2_secrets,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_neighbours": op5_neighbours,
    "op6_line_dedup": op6_line_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_bpe": op8_bpe,
    "op9_language": op9_language,
    "op10_personal_data": op10_personal_data,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op2_secrets": blobscan.oracle(),
    "op6_line_dedup": linedup.oracle_text(),
    "op11_hard_negatives": vptree.oracle(),
    "op12_embedding_dedup": covertree.oracle(),
    "op13_ranked_search": tput.oracle(),
}
