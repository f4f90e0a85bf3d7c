"""A training-data pipeline of five corpus operators over the documents table.

Each stage takes what its predecessor kept, and its decisions take effect: rejected rows are gone.  All stages but the
last return the columns of documents.  Labels and benchmark are read from ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.common import stage, table
from scoreloom.llm.decontaminate import drop_contaminated
from scoreloom.llm.exact_dedup import drop_exact_copies
from scoreloom.llm.near_dedup import near_duplicates
from scoreloom.llm.packing import best_fit_packing
from scoreloom.llm.quality import sample_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; empty texts go where labels tell bad from good."""
    return sample_good(docs, table(spark, sf_dir, "labels")).filter("kept").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle sets with similarity 0.8 or more.

    Rows with one id share its fate; rows without an id cannot be named by a group and stay.
    """
    judged = near_duplicates(docs, percent=80).filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"))
    # The dropped ids are stored, so that the join knows their size: where they are few, no text is shuffled.
    gone = stage(judged.filter("not kept").select("doc_id"), "near-dropped")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 1024 tokens."""
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Resampling, connected components and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
