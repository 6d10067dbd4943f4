"""Monitoring operators: freshness and latency, throughput, match coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.config import Settings
from touchline.functions.clock import now
from touchline.operators.quality import fetched_at
from touchline.operators.snapshot import BROKER_ORDER


def freshness(bronze: DataFrame, settings: Settings, with_percentiles: bool = True) -> DataFrame:
    """Per data type: last message, seconds since it, fetch-to-ingest latency."""
    latency = F.unix_seconds("bronze_ingested_at") - F.unix_seconds(fetched_at())
    aggs = [F.count(F.lit(1)).alias("messages"),
            F.unix_seconds(F.max("kafka_timestamp")).alias("last_message_epoch"),
            (F.unix_seconds(now(settings.as_of)) - F.unix_seconds(F.max("kafka_timestamp")))
            .alias("seconds_since_last"),
            F.min(latency).alias("min_latency_s"),
            F.max(latency).alias("max_latency_s"),
            F.avg(latency).alias("avg_latency_s")]
    if with_percentiles:
        aggs += [F.percentile_approx(latency, p, 10000).alias(f"latency_p{round(100 * p)}_s")
                 for p in (0.5, 0.95)]
    return bronze.groupBy("data_type").agg(*aggs)


def throughput(bronze: DataFrame, every: str = "1 hour") -> DataFrame:
    """Messages per topic and time bucket of the broker clock."""
    return (bronze.groupBy("kafka_topic", F.window("kafka_timestamp", every).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"))
            .select("kafka_topic", F.unix_seconds(F.col("w.start")).alias("window_start_epoch"),
                    "messages"))


def offset_gaps(bronze: DataFrame) -> DataFrame:
    """Per topic partition: offsets spanned vs. distinct offsets seen (missing = lag/loss)."""
    return (bronze.groupBy("kafka_topic", "kafka_partition")
            .agg(F.min("kafka_offset").alias("first_offset"),
                 F.max("kafka_offset").alias("last_offset"),
                 F.count_distinct("kafka_offset").alias("offsets_seen"))
            .withColumn("offsets_missing",
                        F.col("last_offset") - F.col("first_offset") + 1 - F.col("offsets_seen")))


def match_coverage(fixtures: DataFrame, live_scores: DataFrame, settings: Settings) -> DataFrame:
    """Share of fixtures that kicked off before the clock and have a live score.

    Kick-off, league and season are those of a fixture's newest poll. A join written as one
    aggregation: both inputs are tagged, unioned and grouped by fixture once (one
    shuffle, map-side combined, so a fixture polled a million times costs one row per map
    task). No side is broadcast: both grow with the data.
    """
    poll = F.struct("starting_at", "league_id", "season_id")
    fx = fixtures.select("fixture_id", poll.alias("poll"), F.struct(*BROKER_ORDER).alias("at"),
                         F.lit(0).alias("has_live"))
    kinds = {f.name: f.dataType for f in fx.schema}
    lv = live_scores.select("fixture_id", F.lit(None).cast(kinds["poll"]).alias("poll"),
                            F.lit(None).cast(kinds["at"]).alias("at"), F.lit(1).alias("has_live"))
    per_fixture = (fx.unionByName(lv).groupBy("fixture_id")
                   .agg(F.max_by("poll", "at").alias("poll"), F.max("has_live").alias("has_live"))
                   .select("fixture_id", "poll.*", "has_live")
                   .filter(F.try_to_timestamp(F.col("starting_at")) <= now(settings.as_of)))
    return (per_fixture.groupBy("league_id", "season_id")
            .agg(F.count(F.lit(1)).alias("fixtures"),
                 F.sum("has_live").cast("bigint").alias("covered"))
            .withColumn("coverage", F.col("covered") / F.col("fixtures")))
