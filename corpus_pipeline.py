"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import decontamination, jaccard, packing, quality, toxicity
from changeflow.llm.common import fold, table
from changeflow.session import work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.5 or more; it learns from the labels outside its held-out fold."""
    return quality.reject(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the sentence model scores under 0.5; it learns from the labels outside its held-out fold."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that test items do not contaminate."""
    return decontamination.reject(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packed),
]

#: The classifiers are fitted models; tests compare the stages with versions that work row by row.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
