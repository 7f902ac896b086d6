"""The corpus pipeline: language, quality, near duplicates, benchmark leaks, packing.

Each stage works on all that its predecessor kept and returns the columns of ``documents``; the last returns
packed token pieces. Nulls in any column, empty and very long texts, repeated rows, empty tables and further
columns are treated as the operators' docstrings say; rows without an id stay until they are packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import decontam, jaccard, language, packing, quality_rules
from riskframe.llm.common import saved, table
from riskframe.llm.queries import TOKENIZERS

ORACLE_SQL = None  # trained models, trees and a genetic algorithm; tested against brute force in tests/llm


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: no letter, or a pooled probability below the bound."""
    return language.keep_known(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie beyond their group's adaptive thresholds go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity of 0.8 or more) stays, the one with the smallest id."""
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, also with other numbers or names, go."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining documents in as few sequences as possible."""
    return packing.pack_documents(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
