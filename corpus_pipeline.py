"""Documents to training sequences: five stages, each written and read by the next.

quality classifier, near duplicates, substring dedup, benchmark decontamination, packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import decontam, jaccard, packing, quality, substring
from salesloom.llm.queries import table
from salesloom.llm.shipping import ship
from salesloom.plans.session import work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No SQL: the classifier and the tokens can't be written as SQL.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality reaches the threshold; learned from the labelled ones among them.

    Rows whose id is null, or whose text is null or empty, are scored like any other.
    """
    return quality.without_rejects(spark, docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that repeat the smallest id one stays. Documents without words have no duplicates,
    and rows without an id stay unless their group has a row with one.
    """
    ship(spark)
    return jaccard.Join(spark, docs).representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words that repeat."""
    ship(spark)
    return substring.without_repeats(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item and no long part of one."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 ids, with their ids."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, written in between to the shared folder."""
    folder = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
