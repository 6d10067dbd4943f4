"""The live dashboard kept current by a stream over Silver live scores.

The stream's state is the newest row per fixture; each micro-batch hands on the fixtures whose newest row has
changed, and they are merged into a stored table that readers see one version at a time. A version
carries the number of its batch, so a batch that is run again after a restart is passed over, and
finished matches stay in the table as newest rows, so that an older poll cannot bring them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from touchline.config import Settings
from touchline.files import delete
from touchline.operators import analytics as A
from touchline.operators.snapshot import BROKER_ORDER
from touchline.plans.gold import LIVE_COLUMNS
from touchline.sinks.snapshots import snapshot
from touchline.sinks.upsert import upsert_newest
from touchline.sources.tables import read_table
from touchline.streaming.bronze import AVAILABLE_NOW, await_all


def newest_per_fixture(live_scores: DataFrame) -> DataFrame:
    """A stream of the newest row per fixture (update mode: the changed ones of each batch)."""
    rest = [c for c in LIVE_COLUMNS if c != "fixture_id"]
    newest = F.max_by(F.struct(*rest), F.struct(*BROKER_ORDER))
    return (live_scores.where("fixture_id is not null").groupBy("fixture_id").agg(newest.alias("newest"))
            .select("fixture_id", "newest.*").select(*LIVE_COLUMNS))


def merge_batch(batch: DataFrame, batch_id: int, path: str, query_id: str) -> None:
    """Merge a batch's rows unless the table has it already (its state is brought forward all the same)."""
    spark = batch.sparkSession
    have = snapshot(spark, path)
    if have and have.tags.get("query") == query_id and have.tags["batch"] >= batch_id:
        batch.write.format("noop").mode("overwrite").save()
        return
    aside = f"{path}/batches/{batch_id}-{uuid.uuid4().hex[:12]}"
    batch.write.parquet(aside)  # the state is updated once, whatever a merge reads
    upsert_newest(spark, path, spark.read.schema(batch.schema).parquet(aside), "fixture_id",
                  tags={"query": query_id, "batch": batch_id})
    delete(spark, aside)


def start_dashboard(spark: SparkSession, settings: Settings, schema: StructType, trigger: dict | None = None,
                    max_files: int | None = None) -> StreamingQuery:
    """Start the stream over ``silver_stream/live_scores``."""
    reader = spark.readStream.schema(schema).format(settings.table_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    path = settings.path("dashboard", "newest_live")
    checkpoint = settings.path("_checkpoints", "dashboard")
    w = (newest_per_fixture(reader.load(settings.path("silver_stream", "live_scores")))
         .writeStream.outputMode("update").option("checkpointLocation", checkpoint).queryName("live_dashboard")
         .foreachBatch(lambda batch, n: merge_batch(batch, n, path, checkpoint)))
    return (w.trigger(**trigger) if trigger else w).start()


def run_dashboard(spark: SparkSession, settings: Settings, max_files: int | None = None) -> dict:
    """Bring the dashboard up to the Silver rows that are there now."""
    schema = spark.read.format(settings.table_format).load(settings.path("silver_stream", "live_scores")).schema
    query = start_dashboard(spark, settings, schema, AVAILABLE_NOW, max_files)
    return await_all(spark, {"live_dashboard": query})["live_dashboard"]


def newest_live(spark: SparkSession, settings: Settings) -> DataFrame:
    """The newest row per fixture, as of the last merged batch."""
    return read_table(spark, settings.path("dashboard", "newest_live"), settings.table_format).select(*LIVE_COLUMNS)


def current_dashboard(spark: SparkSession, settings: Settings) -> DataFrame:
    """The dashboard as of the last merged batch."""
    return A.live_dashboard(newest_live(spark, settings), settings)
