"""Bronze ingest as streaming queries: one append stream per data type."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from touchline.config import Settings
from touchline.session import tune
from touchline.operators.ingest import to_bronze
from touchline.sinks.tables import stream_append
from touchline.sources.stream import StreamSource, record_stream

AVAILABLE_NOW = {"availableNow": True}


def start_bronze(spark: SparkSession, data_type: str, src: StreamSource, settings: Settings,
                 bronze_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start one stream: broker records -> decode -> stamps -> date parts -> append.

    Every message is kept. Exact re-deliveries are dropped downstream by topic, partition and
    offset (``drop_redeliveries``): a watermark here would lose late messages never seen before.
    """
    df = to_bronze(record_stream(spark, src), data_type, settings)
    return stream_append(df, bronze_path, checkpoint, settings.table_format,
                         trigger=trigger, query_name=f"bronze_{data_type}",
                         retention=settings.bronze_retention)


def await_all(spark: SparkSession, queries: dict[str, StreamingQuery]) -> dict[str, dict]:
    """Wait until every query ends; if one fails, stop the others and raise.

    Waits on these queries only: streams of other callers in the session neither end
    the wait nor are stopped. Returns the last progress per query for the run report.
    """
    pending = dict(queries)
    try:
        while pending:
            for name, q in list(pending.items()):
                if q.awaitTermination(1 if len(pending) > 1 else 10):  # raises if q failed
                    del pending[name]
    except BaseException:  # a failed stream, or an interrupt: stop our streams
        for q in queries.values():
            if q.isActive:
                q.stop()
        raise
    return {n: (q.lastProgress or {}) for n, q in queries.items()}


def run_bronze(spark: SparkSession, sources: dict[str, StreamSource], settings: Settings,
               trigger: dict | None = AVAILABLE_NOW) -> dict[str, dict]:
    """Start all Bronze streams at once and wait for them (all four run concurrently)."""
    tune(spark)
    queries = {
        dt: start_bronze(spark, dt, src, settings, settings.path("bronze", dt),
                         settings.path("_checkpoints", "bronze", dt), trigger)
        for dt, src in sources.items()
    }
    return await_all(spark, queries)
