"""A training corpus in five stages, each written as Parquet before the next one starts.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``.  ``ORACLE_SQL`` is None: neither a trained classifier nor signatures nor packing can be said in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilmark.llm import exact_dup, mixing, near_dup, packing, quality
from veilmark.llm.scratch import stored, table

ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return exact_dup.keep_first(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, from a similarity of 0.8 on, the one with the smallest id."""
    return near_dup.keep_one(docs, link=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents left out, kept or repeated."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality", good),
    ("exact_dedup", unique),
    ("near_dedup", distinct),
    ("mixing", mixture),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
