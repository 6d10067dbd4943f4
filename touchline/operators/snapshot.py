"""Repeated messages: newest snapshot per key, and exact re-deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broker order of a message: time, then partition, then offset.
BROKER_ORDER = ("kafka_timestamp", "kafka_partition", "kafka_offset")

# Snapshot keys per Silver table.
SNAPSHOT_KEYS = {
    "fixtures": ("fixture_id",),
    "live_scores": ("fixture_id",),
    "events": ("fixture_id", "event_id"),
}


def latest_snapshot(df: DataFrame, keys: Sequence[str],
                    order: Sequence[str] = BROKER_ORDER) -> DataFrame:
    """Keep the newest row per key, newest by broker order.

    ``max_by`` reduces map-side (partial aggregation) before the shuffle, so a key that
    was polled millions of times sends one row per map task, not all its copies; a
    ``row_number`` window would shuffle every copy into one task.
    """
    rest = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_latest"))
    return latest.select(*[F.col(k) for k in keys], "_latest.*").select(*df.columns)


def duplicate_report(bronze: DataFrame) -> DataFrame:
    """Exact re-deliveries: one row per (topic, partition, offset) seen more than once."""
    return (bronze.groupBy("kafka_topic", "kafka_partition", "kafka_offset")
            .agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def drop_redeliveries(bronze: DataFrame) -> DataFrame:
    return bronze.dropDuplicates(["kafka_topic", "kafka_partition", "kafka_offset"])
