"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes all documents that the one before kept and returns documents
again (the last: their tokens); between stages they are written as Parquet.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import byte_bpe, decontaminate, frames, line_dedup, quality_rules, simhash
from quillon.llm.queries import BYTE_BPE


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them have, but for the first that has them; n_chars follows the text.

    Documents of the same words count once and are first together: near-dedup keeps one of them, with its text.
    """
    kept = line_dedup.dedup_lines(docs, min_docs=10, keep="first", copies_once=True)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest doc_id, of each group of similarity 0.8 over five-word shingles."""
    return simhash.keep_one(docs, words=5, similarity=0.8)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document left: doc_id, n_tokens, token_ids, and digests of ids and decoded text."""
    return byte_bpe.encode(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]

#: Forests, fingerprints, tilings and merges are not SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = frames.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
