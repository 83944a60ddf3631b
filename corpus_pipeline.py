"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

A stage takes ``(spark, docs, sf_dir)`` and returns what the next one reads. All but the last
return the columns of ``documents`` unchanged for the documents they keep.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tracemill.llm import decontaminate, exact_dedup, jaccard_join, language_id, packing
from tracemill.llm.common import table
from tracemill.session import shared_dir, temporary_steps


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, a good part of them in one known language."""
    return language_id.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked near copies."""
    return jaccard_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of test items."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its token sequence and its place there."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", sequences),
]

#: The stages learn, hash and pack by rules that SQL does not express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        with temporary_steps(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(f"{base}/{number}")
        docs = spark.read.parquet(f"{base}/{number}")
    return docs
