"""Layer-table scans with lookback windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.config import Settings
from touchline.functions.clock import today
from touchline.sinks.compact import compact_path, read_streamed
from touchline.sinks.snapshots import has_snapshot, read_snapshot, snapshot


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None) -> DataFrame:
    """A stored table: its newest snapshot, resolved now, or the folder as it is (streamed tables, which
    need a ``schema`` as long as they may hold no file)."""
    snap = snapshot(spark, path) if fmt != "delta" else None
    if snap:
        return read_snapshot(spark, snap, fmt)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(fmt).load(path)


def lookback(df: DataFrame, ts_col: str, days_back: int | None, as_of: str | None,
             partitions_follow: bool = False) -> DataFrame:
    """Keep rows with ``ts_col >= date_sub(today, days_back)``; ``None`` keeps all.

    When the table is partitioned by the date of ``ts_col`` itself
    (``partitions_follow``), the same cut is also stated on the partition columns, so the
    scan skips old day folders (it shows under ``PartitionFilters``). The cut is at
    midnight, a whole day, so no partition is ever split.
    """
    if days_back is None:
        return df
    cutoff = F.date_sub(today(as_of), days_back)
    cond = F.col(ts_col) >= cutoff
    if partitions_follow:
        cond = cond & (F.make_date("year", "month", "day") >= cutoff)
    return df.filter(cond)


FROM_SETTINGS = -1  # days_back not given: the setting decides (None means all history)


def read_bronze_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bronze as batch runs read it: compacted days and the streamed files beside them."""
    if fmt != "delta" and has_snapshot(spark, compact_path(path)):
        return read_streamed(spark, path, fmt)
    return read_table(spark, path, fmt)


def read_bronze(spark: SparkSession, path: str, settings: Settings,
                days_back: int | None = FROM_SETTINGS) -> DataFrame:
    """Bronze scan with the ingest-time lookback (default ``settings.bronze_days_back``)."""
    days = settings.bronze_days_back if days_back == FROM_SETTINGS else days_back
    df = read_bronze_table(spark, path, settings.table_format)
    return lookback(df, "bronze_ingested_at", days, settings.as_of, partitions_follow=True)


def read_silver(spark: SparkSession, path: str, settings: Settings,
                days_back: int | None = FROM_SETTINGS) -> DataFrame:
    """Silver scan with the processing-time lookback (default ``settings.silver_days_back``).

    Silver is partitioned by the ingest date. With the record clock, rows are processed at their ingest
    time, so older partitions are skipped. Otherwise, a Silver run reads Bronze at most
    ``settings.bronze_days_back`` days back, so a row processed after the cut-off was ingested
    at most that many days before it: with that lookback set, older partitions are skipped.
    """
    days = settings.silver_days_back if days_back == FROM_SETTINGS else days_back
    follows = settings.ingest_clock == "record"
    df = lookback(read_table(spark, path, settings.table_format), "silver_processed_at",
                  days, settings.as_of, partitions_follow=follows)
    if not follows and days is not None and settings.bronze_days_back is not None:
        first = F.date_sub(today(settings.as_of), days + settings.bronze_days_back)
        df = df.filter(F.make_date("year", "month", "day") >= first)
    return df
