"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.llm import (
    byte_bpe, compression_rules, conversation_repair, embedding_dedup, fingerprints, html_blocks, mixing, ppm,
    quality_gam, simhash_dedup, substring_dedup, token_files, whitening,
)
from winnowry.llm.common import small_batches
from winnowry.staging import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=3, radius=2)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@_register
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("copies")


SQL["op4_mix_sources"] = mixing.SQL


@_register
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed_words(_table(spark, sf_dir, "documents"))


def labels_to_learn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels outside the held-out part."""
    return _table(spark, sf_dir, "labels").where(quality_gam.fold() != 1)


@_register
def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_gam.fit_quality(docs, labels_to_learn(spark, sf_dir))
    return quality_gam.score_quality(docs, model).select(
        "doc_id", F.coalesce(quality_gam.fold() == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_register
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@_register
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.id_digests(token_files.write_ids(_table(spark, sf_dir, "documents"), path, end_id=2))


@_register
def op3_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.language_scores(_table(spark, sf_dir, "documents"), "crc32(CAST(doc_id AS STRING)) % 7 = 2")


@_register
def op6_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage(fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents")), "edited")
    return fingerprints.with_near_counts(found).select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.hex_digits("fp").alias("fingerprint"),
        fingerprints.hex_digits("edited_fp").alias("edited_fingerprint"),
        fingerprints.likeness("fp", "edited_fp").alias("near_edited"),
        fingerprints.likeness("fp", "next_fp").alias("near_next"), "n_near",
    )


@_register
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.linked_vectors(_table(spark, sf_dir, "embeddings"))


SQL["op5_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT a AS vec_id, b AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), component AS (
  SELECT e.vec_id, least(e.vec_id, min(r.other)) AS component_id
  FROM embeddings e LEFT JOIN reach r ON e.vec_id = r.vec_id GROUP BY e.vec_id
), counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT c.vec_id, coalesce(n, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM component c LEFT JOIN counted ON c.vec_id = counted.vec_id
"""


@_register
def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.train_labeller(pages))


SQL["op10_substring_dedup"] = substring_dedup.SQL


@_register
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules.quality_rules(_table(spark, sf_dir, "documents"))


@_register
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@_register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(_table(spark, sf_dir, "conversations"))


SQL["op11_conversation_repair"] = conversation_repair.SQL
