"""A training corpus from raw documents, stage by stage.

Each stage gets the rows that the one before has written and returns them with all their
columns, but for the last. Rows with null or empty texts, null ids and repeated ids go
through every stage; extra columns are carried along whatever their names; an empty table stays
empty. What each stage does with such rows its function says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import decontamination, jaccard, packing, pii, quality
from lakeward.llm.common import stage, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps. A null or empty text weighs nothing and is
    judged by that; rows that repeat id and text share their fate; without labels all stay."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the smallest id.
    Texts without words are no copies of one another; rows without an id stay, and so do rows that
    repeat an id that stays."""
    return jaccard.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window. Texts without words stay; rows that repeat id and
    text go or stay together."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and access keys replaced in the texts; null texts stay null."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences. A null text is packed as an empty one; every row
    is packed, repeated or not."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", clean),
    ("personal_data", private),
    ("packing", packed),
]
#: Sampling noise, set similarity and tokens are beyond SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written output of the one before, which survives lost executors."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = apply(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stage(docs, f"pipeline-{name}")
    return docs
