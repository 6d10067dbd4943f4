"""Corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from touchline.llm.tables import read_table, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (operator 10)."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 9)."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group (operator 6)."""
    return simhash.keep_one_near(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes that an earlier one holds (operator 4)."""
    return suffix_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 tokens (operator 7)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good), ("exact_dedup", exact), ("simhash_dedup", near),
          ("suffix_array_dedup", substrings), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each stage's rows are written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# The stages are not expressible in SQL; tests compare them with brute-force versions.
ORACLE_SQL = None
