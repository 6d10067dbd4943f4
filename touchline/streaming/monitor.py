"""Monitoring on streams: re-deliveries dropped, and messages per window, with late ones accounted for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import Settings
from touchline.operators.ingest import decode_records
from touchline.schemas import KAFKA_RECORD
from touchline.session import release
from touchline.sinks.tables import stream_append
from touchline.streaming.bronze import AVAILABLE_NOW, await_all
from touchline.streaming.late import late_rows, route_late
from touchline.streaming.redeliveries import (  # noqa: F401
    DELAY_SECONDS, MESSAGE, kept_messages, start_kept, without_redeliveries,
)


def window_counts(messages: DataFrame, every: str = "1 hour", delay_seconds: int = DELAY_SECONDS) -> DataFrame:
    """A stream of message counts per topic and window, each given once, when its window has closed."""
    return (messages.withWatermark("kafka_timestamp", f"{delay_seconds} seconds")
            .groupBy("kafka_topic", F.window("kafka_timestamp", every).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"))
            .select("kafka_topic", F.unix_seconds("w.start").alias("window_start_epoch"), "messages"))


def corrections(late: DataFrame, every: str = "1 hour") -> DataFrame:
    """What late messages add to the counts of their windows."""
    return (late.groupBy("kafka_topic", F.window("kafka_timestamp", every).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"))
            .select("kafka_topic", F.unix_seconds("w.start").alias("window_start_epoch"), "messages"))


def corrected_counts(closed: DataFrame, late: DataFrame, every: str = "1 hour") -> DataFrame:
    """Counts of closed windows with their corrections: messages, and how many of them came late.

    A window all of whose messages came late has a correction only; it counts as closed if one after it is.
    """
    both = (closed.withColumn("late", F.lit(0).cast("bigint"))
            .unionByName(corrections(late, every).withColumn("late", F.col("messages"))))
    last = closed.agg(F.max("window_start_epoch").alias("last"))
    return (both.groupBy("kafka_topic", "window_start_epoch")
            .agg(F.sum("messages").alias("messages"), F.sum("late").alias("late"))
            .join(last, F.col("window_start_epoch") <= F.col("last"), "left_semi"))


def redelivery_report(kept: DataFrame, late: DataFrame, messages: DataFrame) -> DataFrame:
    """Per topic: messages, kept ones, late ones never seen before, and repeats (all others)."""
    unseen = (late.select(*MESSAGE).distinct().join(kept.select(*MESSAGE), MESSAGE, "left_anti"))
    parts = (messages.groupBy("kafka_topic").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("messages"))
             .unionByName(kept.groupBy("kafka_topic").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("kept")))
             .unionByName(unseen.groupBy("kafka_topic").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("late"))))
    counts = parts.groupBy("kafka_topic").agg(*[
        F.coalesce(F.sum(F.when(F.col("what") == c, F.col("n"))), F.lit(0)).alias(c) for c in ("messages", "kept", "late")])
    return counts.withColumn("repeats", F.col("messages") - F.col("kept") - F.col("late"))


def run_monitors(spark: SparkSession, settings: Settings, landed: str, delay_seconds: int = DELAY_SECONDS) -> str:
    """One run over what has landed (broker records): route late messages, then the two streams
    over the on-time ones. Returns the folder of their tables."""
    out, checkpoints = settings.path("monitor"), settings.path("_checkpoints", "monitor")
    records = decode_records(spark.readStream.schema(KAFKA_RECORD).parquet(landed))
    await_all(spark, {"route": route_late(records, out, f"{checkpoints}/route", "kafka_timestamp", delay_seconds,
                                          AVAILABLE_NOW, "monitor_route")})
    on_time = f"{out}/on_time"
    await_all(spark, {
        "kept": start_kept(spark, on_time, records.schema, f"{out}/kept", f"{checkpoints}/kept", delay_seconds,
                           AVAILABLE_NOW, "monitor_kept"),
        "windows": stream_append(
            window_counts(spark.readStream.schema(records.schema).parquet(on_time), delay_seconds=delay_seconds),
            f"{out}/windows", f"{checkpoints}/windows", "parquet", partition_by=(), trigger=AVAILABLE_NOW,
            query_name="monitor_windows")})
    release(spark)
    return out


def monitor_tables(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept messages, closed windows, late messages) of earlier runs."""
    kept = kept_messages(spark, f"{out}/kept")
    return kept, spark.read.parquet(f"{out}/windows"), late_rows(spark, out, kept.schema)
