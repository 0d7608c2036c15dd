"""Prepares a corpus for training: documents in, the pieces of clean, distinct, uncontaminated, redacted documents out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from haulwatch.llm import decontamination, near_duplicates, pieces, quality_rules, secret_scans
from haulwatch.llm.queries import PIECES, table
from haulwatch.llm.storage import shared_folder


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    into = "__rules"
    return quality_rules.judge_quality(docs, PIECES, into=into).where(f"{into}.kept").select(*docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return near_duplicates.dedupe(docs)


def unseen_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redacted_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live credentials in them replaced and n_chars counted anew."""
    return secret_scans.redact(docs)


def encoded_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their pieces."""
    return pieces.encode_documents(docs, PIECES)


STAGES = [
    ("quality rules", good_texts),
    ("near-duplicates", distinct_texts),
    ("decontamination", unseen_texts),
    ("secrets", redacted_texts),
    ("pieces", encoded_texts),
]

#: The rules and the pieces depend on a vocabulary file, which SQL cannot read.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage reads what the one before has written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
