"""Corpus pipeline: quality rules, exact dedup, near dedup, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before has written. All but
the last return documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidedock.llm import exact, near, packing, quality, repeats
from tidedock.llm.tables import read, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds."""
    return quality.kept_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of similar texts."""
    return near.kept_documents(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without byte strings that a document with a smaller id has."""
    return repeats.shortened_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack(docs, plain=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("best_fit_packing", packing_stage),
]

#: Tokenizing and removal of repeated byte strings are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
