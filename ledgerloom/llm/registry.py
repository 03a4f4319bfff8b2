"""The queries of this subpackage, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import byte_bpe, collocations, decontaminate, hard_negatives, katz, lang_id, licenses, pii, rp_forest, simhash, substring_dedup, toxicity, url_filter
from ledgerloom.llm.kernels import documents


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.held_out_scores(documents(spark, sf_dir))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def op7_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


_QUERIES = (
    op1_lang_id, op2_pii, op3_simhash, op4_katz, op5_byte_bpe, op6_substring_dedup, op7_rp_forest, op8_toxicity, op9_licenses, op10_decontaminate,
    op11_hard_negatives, op12_url_filter, op13_collocations,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op9_licenses": licenses.oracle(), "op11_hard_negatives": hard_negatives.ORACLE, "op12_url_filter": url_filter.oracle(), "op13_collocations": collocations.ORACLE}
