"""Incremental Silver from the Bronze table, with its dead letters.

The Silver transforms are stateless per row, so a Bronze table read as a file stream,
refined and appended with a checkpoint gives exactly-once incremental Silver. Run it
with ``availableNow`` on a schedule: each run processes only files it has not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from touchline.config import Settings
from touchline.operators.quality import dead_letters
from touchline.operators.refine import REFINERS
from touchline.schemas import BRONZE_DDL
from touchline.sinks.tables import stream_append
from touchline.streaming.bronze import AVAILABLE_NOW, await_all


def bronze_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE_DDL).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def start_silver(spark: SparkSession, settings: Settings, data_type: str, table: str,
                 trigger: dict | None = AVAILABLE_NOW) -> dict[str, StreamingQuery]:
    """Start two streams: Silver rows of new Bronze files, and bad messages as dead letters."""
    src = bronze_stream(spark, settings.path("bronze", data_type), settings.table_format)
    outputs = {table: REFINERS[data_type](src, settings),
               f"dead_letters_{table}": dead_letters(src, data_type, settings)}
    return {
        name: stream_append(df, settings.path("silver_stream", name),
                            settings.path("_checkpoints", "silver_stream", name),
                            settings.table_format, trigger=trigger,
                            query_name=f"silver_stream_{name}")
        for name, df in outputs.items()}


def run_silver_incremental(spark: SparkSession, settings: Settings, data_type: str,
                           table: str, trigger: dict | None = AVAILABLE_NOW) -> dict:
    return await_all(spark, start_silver(spark, settings, data_type, table, trigger))[table]


def run_silver_streams(spark: SparkSession, settings: Settings, tables: dict[str, str],
                       trigger: dict | None = AVAILABLE_NOW) -> dict[str, dict]:
    """The streams of several data types at once: the last tasks of one leave no core idle."""
    queries: dict[str, StreamingQuery] = {}
    for data_type, table in tables.items():
        queries |= start_silver(spark, settings, data_type, table, trigger)
    return await_all(spark, queries)
