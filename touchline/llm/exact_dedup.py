"""Exact de-duplication by skew-safe combining (DataFrame functions only).

Texts are equal when identical after lower-casing A-Z. Three combining stages, each
grouping by the digest *and* the full normalised content:

1. local: the partial aggregate of every map task keeps one row per content it read;
2. salted: the rows of one content meet in at most ``salts`` groups, so a content held by
   a third of all rows never meets in one task;
3. global: the salt winners of a content (at most ``salts``) are combined.

Membership then needs narrow rows only: every document looks its digest up among the
winners with more than one row, salted again. Should two contents ever share a digest,
the look-up compares contents as well.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.tables import free_names, stored, whole

SALTS = 16


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays (null reads as empty)."""
    t = whole(text)
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(
        F.translate(t, string.ascii_uppercase, string.ascii_lowercase))


def _contents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("content"))
            .withColumn("digest", F.unhex(F.sha2("content", 256))))


def combine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            salts: int = SALTS) -> DataFrame:
    """One row per distinct content: digest, content, keep_id (largest id), n_rows."""
    salted = (_contents(docs, id_col, text_col)
              .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("digest", "salt", "content")
              .agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n")))
    return (salted.groupBy("digest", "content")
            .agg(F.max("id").alias("keep_id"), F.sum("n").alias("n_rows")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                salts: int = SALTS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Defined cases: a null text equals the empty text; a null id stays only if no row of its
    group has an id (keep_id is then null); rows that repeat one id and text count in
    group_size, and one of them is kept; an empty table gives no rows; other columns are ignored.
    """
    winners = stored(combine(docs, id_col, text_col, salts)
                     .groupBy("digest").agg(F.max("keep_id").alias("keep_id"),
                                            F.sum("n_rows").alias("n_rows"),
                                            F.count(F.lit(1)).alias("n_contents"))
                     .where("n_rows > 1"), "exact-winners")
    rows = _contents(docs, id_col, text_col)
    salt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    if winners.where("n_contents > 1").isEmpty():
        spread = (winners.select(F.col("digest").alias("w_digest"), "keep_id", "n_rows",
                                 F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("w_salt")))
        joined = (rows.select("id", "digest", salt.alias("salt"))
                  .join(spread, (F.col("digest") == F.col("w_digest"))
                        & (F.col("salt") == F.col("w_salt")), "left"))
        content = []
    else:  # a digest shared by different contents: compare the contents themselves
        found = (combine(docs, id_col, text_col, salts)
                 .select(F.col("digest").alias("w_digest"), F.col("content").alias("w_content"),
                         "keep_id", "n_rows"))
        joined = rows.join(found, (F.col("digest") == F.col("w_digest"))
                           & (F.col("content") == F.col("w_content")), "left")
        content = ["content"]
    grouped = joined.select(
        "id", "digest", *content,
        F.when(F.col("n_rows").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n_rows", F.lit(1)).cast("long").alias("group_size"))
    # Rows that repeat the winner's id and text: one of them stays.
    first = F.row_number().over(Window.partitionBy("id", "digest", *content).orderBy("keep_id"))
    return grouped.withColumn("nth", first).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    own, sha, digest = free_names(docs, "kept_id", "kept_sha", "digest")
    kept = (exact_dedup(docs, id_col, text_col, salts).where("kept")
            .select(F.col("doc_id").alias(own), F.unhex("text_sha256").alias(sha)))
    marked = docs.withColumn(digest, F.unhex(F.sha2(ascii_lower(F.col(text_col)), 256)))
    return (marked.join(kept, marked[id_col].eqNullSafe(F.col(own))
                        & (F.col(digest) == F.col(sha)), "left_semi")
            .dropDuplicates([id_col, digest]).drop(digest))


ORACLE = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
