"""Data-quality operators: dead letters, failure rate, NULL profile, timestamp checks,
row flags. All are single-pass aggregates or per-row projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.config import Settings
from touchline.operators.refine import (
    DROPPED_REASONS, MSG, PARTIAL, REASON, parsed_with_reason,
)
from touchline.schemas import CORRUPT, SCHEMAS


def parsed(bronze: DataFrame, data_type: str) -> DataFrame:
    """The Bronze rows with ``msg`` and ``bad_reason`` (parsed once, reused if present)."""
    if REASON in bronze.columns:
        return bronze
    return parsed_with_reason(bronze, SCHEMAS[data_type])


def dead_letters(bronze: DataFrame, data_type: str, settings: Settings) -> DataFrame:
    """Messages that failed to parse, with the reason and the parser's corrupt text.

    ``partial`` rows are copied here and also stay in Silver.
    """
    p = parsed(bronze, data_type)
    return (p.filter(F.col(REASON).isNotNull())
            .select("kafka_key", "raw_json", "kafka_topic", "kafka_partition", "kafka_offset",
                    "kafka_timestamp", "bronze_ingested_at", "data_type",
                    F.col(REASON).alias("reason"),
                    F.col(f"{MSG}.{CORRUPT}").alias("corrupt_record"),
                    "year", "month", "day"))


def failure_rate(bronze: DataFrame, data_type: str) -> DataFrame:
    """Per data type: messages, dropped (bad) messages, partial ones, and the share."""
    p = parsed(bronze, data_type)
    dropped = F.col(REASON).isin(*DROPPED_REASONS)
    return p.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(dropped).alias("dead_letters"),
        F.count_if(F.col(REASON) == PARTIAL).alias("partial"),
        F.avg(F.coalesce(dropped, F.lit(False)).cast("double")).alias("failure_rate"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count and share per column, from ONE scan (then unpivoted to rows)."""
    cols = columns or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot(["rows"], cols, "column_name", "null_count")
    return long.withColumn("null_share", F.col("null_count") / F.col("rows"))


def fetched_at(text: str = "raw_json") -> Column:
    """The poller's fetch time from the message envelope (NULL if missing or bad)."""
    return F.try_to_timestamp(F.get_json_object(F.col(text), "$._metadata.fetched_at"))


def timestamp_checks(bronze: DataFrame) -> DataFrame:
    """Order of clocks per data type: fetched <= broker time <= ingest time."""
    f = fetched_at()
    return bronze.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(f.isNull()).alias("missing_fetched_at"),
        F.count_if(f > F.col("kafka_timestamp")).alias("fetched_after_broker"),
        F.count_if(F.col("kafka_timestamp") > F.col("bronze_ingested_at"))
        .alias("broker_after_ingest"))


# Row quality flags of live scores.
FLAG_NULL_SCORE = "NULL_SCORE_ON_FINISHED"
FLAG_MISSING_TEAM = "MISSING_TEAM"
FLAG_BAD_DATE = "BAD_DATE"
FLAG_MISSING_STATE = "MISSING_STATE"


def quality_flags(live_scores: DataFrame) -> DataFrame:
    """Live-score rows that carry at least one quality flag, with the flags."""
    checks = [
        (F.col("is_finished") & (F.col("home_score").isNull() | F.col("away_score").isNull()),
         FLAG_NULL_SCORE),
        (F.col("home_team").isNull() | F.col("away_team").isNull(), FLAG_MISSING_TEAM),
        (F.col("starting_at").isNotNull() & F.col("match_date").isNull(), FLAG_BAD_DATE),
        (F.col("state_id").isNull(), FLAG_MISSING_STATE),
    ]
    flags = F.filter(F.array(*[F.when(c, F.lit(name)) for c, name in checks]),
                     lambda x: x.isNotNull())
    return (live_scores.select("fixture_id", "kafka_partition", "kafka_offset",
                               flags.alias("flags"))
            .filter(F.size("flags") > 0))
