"""The registered queries of this subpackage: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chanloom.llm import (cuckoo, jaccard_join, mixing, packing, pii, prefix_tokens, quality_kn, quality_rules, revisits, token_alignment, toxicity,
                          vertical_scan, weighted_sampling)
from chanloom.llm.common import documents, table
from chanloom.llm.tokenizer_files import byte_bpe, piece_bpe


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(documents(spark, sf_dir))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.edited_fingerprints(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolve_revisits(revisits.page_records(table(spark, sf_dir, "pages")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.duplicates(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.token_counts(documents(spark, sf_dir), byte_bpe())


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_kn.quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), byte_bpe())


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned_documents(documents(spark, sf_dir), byte_bpe(), piece_bpe())


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vertical_scan.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_weighted_sampling": op2_weighted_sampling,
    "op3_pii": op3_pii,
    "op4_revisits": op4_revisits,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_token_alignment": op11_token_alignment,
    "op12_quality_rules": op12_quality_rules,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op4_revisits": revisits.ORACLE_SQL,
    "op13_hard_negatives": vertical_scan.ORACLE_SQL,
    "op5_exact_dedup": """
        WITH d AS (
          SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id,
               min(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
               text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
}
