"""The training-data pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each one as Parquet into the shared checkpoint folder and reads it
again as the next one's input.  All stages but the last return the columns
of ``documents``.  Counts, models and indexes are computed on each stage's
own input.  SQL cannot express the stages (language model, random rounding,
retrieval), so ORACLE_SQL is None and tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chanloom.llm import cuckoo, jaccard_join, mixing, packing, quality_kn
from chanloom.llm.common import documents, materialize, table
from chanloom.llm.tokenizer_files import byte_bpe


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_kn.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cuckoo.keep_first(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, byte_bpe())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
