"""One registered query per operator, over the whole intended table, and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (bpe, embedding_dedup, exact_dedup, hard_negatives, mixing, packing, quality,
                           simhash, suffix_dedup, url_filter, warc, whitening, window_dedup)
from touchline.llm.tables import read_table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.archive_roundtrip(read_table(spark, sf_dir, "pages"))
            .drop("record_id", "target_uri"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    labels = read_table(spark, sf_dir, "labels")
    return url_filter.judge_urls(pages, url_filter.labelled_urls(pages, labels))


def op3_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(read_table(spark, sf_dir, "embeddings"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"), with_text=False)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.window_dedup(read_table(spark, sf_dir, "documents"), with_text=False)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (whitening.whiten(read_table(spark, sf_dir, "embeddings"))
            .withColumn("deviation", F.col("deviation").try_cast("long")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_url_rules": op2_url_rules,
    "op3_embedding_pq": op3_embedding_pq,
    "op4_suffix_array": op4_suffix_array,
    "op5_bpe": op5_bpe,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_substring": op8_substring,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_mixing": op13_mixing,
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.ORACLE,
    "op3_embedding_pq": embedding_dedup.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_mixing": mixing.ORACLE,
}
