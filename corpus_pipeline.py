"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again by the next one.

Defined cases are those of the operators: null, empty and wordless texts fail
the quality rules; an empty table passes through all stages; extra columns of
``documents`` pass through to the last stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paneltide.llm import bin_packing, language_id, line_dedup, line_quality, prob_minhash
from paneltide.llm.common import materialise
from paneltide.llm.queries import documents, tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much or fail the base rule."""
    return line_quality.clean(docs)


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language model accepts go."""
    return language_id.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return prob_minhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut; the earliest occurrence stays."""
    return line_dedup.dedupe(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048."""
    return bin_packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("language_id", language_filter), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("packing", packing)]

# hashed models and tokenizers are beyond SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
