"""A training corpus from raw documents: stages over ``documents``, in order.

Every stage works on all rows that the one before it kept and handles null
texts, sources and ids, empty tables and extra columns as its operator does.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from winnowry.llm import byte_bpe, mixing, quality_gam, simhash_dedup, substring_dedup
from winnowry.llm.common import small_batches
from winnowry.session import short_shuffles, small_buffers, use_local_folder
from winnowry.staging import stage

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects; it learns from the labels outside the held-out part.

    An empty text is judged like any other. Decisions are made per row, so rows
    that repeat a ``doc_id``, or have none, need no key.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(quality_gam.fold() != 1)
    return quality_gam.accepted(docs, quality_gam.fit_quality(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest ``doc_id`` of texts with similar five-word shingles."""
    return simhash_dedup.one_of_each(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 words that a document with a smaller ``doc_id`` holds."""
    return substring_dedup.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their target weights."""
    return mixing.emit_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every row, with what they decode to: one row per row of ``docs``."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN)


def _with_folder(step: Step) -> Step:
    """The stage, with small batches and buffers of texts and short-lived shuffle files, and with a folder for tables where the session names none."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        use_local_folder(spark)
        small_batches(spark)
        small_buffers(spark)
        short_shuffles(spark)
        return step(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Step]] = [
    ("quality", _with_folder(quality)),
    ("near_dedup", _with_folder(near_dedup)),
    ("substring_dedup", _with_folder(substring_dedup_stage)),
    ("mix", _with_folder(mix)),
    ("tokenize", _with_folder(tokenize)),
]

#: SQL can express neither the classifier nor the near-duplicate search nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again by the next."""
    use_local_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
