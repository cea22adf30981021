"""The training-data pipeline: from raw documents to packed sequences, a stage for each decision.

Each stage takes (spark, docs, sf_dir) and gives the next one's documents; the last gives the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seatracks.llm import common, near_dedup, packing, quality_rules, secret_scan, substring_dedup

#: Not expressible in SQL: host verdicts aside, the later stages need merges, tokens and packing.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_dedup.kept_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document with a smaller id has."""
    return substring_dedup.deduped_documents(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens."""
    return packing.pack(docs, common.tokenizer_path("word_bpe_49k.json"), size=2048)


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("secret_scan", secrets),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each gives is written to the shared folder and read again."""
    docs, home = common.load(spark, sf_dir), common.shared_dir(spark)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"{home}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
