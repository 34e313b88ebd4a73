"""A corpus pipeline: rules, exact copies, near copies, mixing and encoding, each stage on all that the one before kept.

All stages take nulls in any column, empty and long texts, repeated rows and columns of any name; an empty table gives
no rows. What each makes of them, and of ties, is said at the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docspark.llm import bpe, exact, jaccard, mixing, quality
from docspark.llm.common import staged

#: Words in a shingle and least similarity, in percent, of near copies.
SHINGLE, SIMILAR = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return jaccard.drop_similar(docs, width=SHINGLE, percent=SIMILAR)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the mix."""
    return bpe.coded(docs, bpe.default_path())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixing_weights),
    ("BPE encoding and decoding", encoding),
]

#: SQL cannot express the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`, each written and read again; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
