"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the
columns of ``documents``; the last returns token ids.  No stage is expressible in SQL (a trained
network, a covering-code search, a random walk, checksums and byte merges), so ORACLE_SQL is None.  ``tests/llm``
test near copies, benchmark passages, base spans and tokens against brute force, the language by held-out accuracy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import byte_bpe, decontaminate, lang_id, near_copies, pii
from ledgerloom.llm.kernels import documents, fold_crc, shared_dir

LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those that no language fits, go."""
    return lang_id.keep_identified(docs, lang_id.train(docs, fold_crc("doc_id", 3) != 1), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8) the document with the smallest id stays."""
    return near_copies.keep_representatives(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text."""
    return pii.redact(docs, "text", "n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256 and decoded_sha256 of every document that is left."""
    return byte_bpe.digest(docs, keep_ids=True)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what stands between two stages is Parquet in the shared folder."""
    shared_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {}
