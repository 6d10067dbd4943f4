"""Streams: replay = batch, restart without loss or repeat, TTL de-duplication."""

from pyspark.sql import functions as F

from touchline.operators.ingest import to_bronze
from touchline.plans import lineage as L
from touchline.sources.demo import demo_records
from touchline.sources.stream import StreamSource, kafka_options
from touchline.sources.tables import read_table
from touchline.streaming.bronze import run_bronze
from touchline.streaming.incremental import run_silver_incremental
from tests.conftest import SF_SMALL

KEY_COLS = ["kafka_topic", "kafka_partition", "kafka_offset", "raw_json", "year", "month", "day"]


def test_replay_equals_batch_and_restart_is_exact(spark, scratch):
    settings = L.demo_settings(root=scratch)
    records = demo_records(spark, SF_SMALL, "livescores")
    landing = f"{scratch}/landing/livescores"
    # first half of the records lands, the stream runs, then the rest lands and it runs again
    records.filter(F.col("offset") % 2 == 0).write.mode("append").parquet(landing)
    src = {"livescores": StreamSource(kind="files", path=landing, max_per_trigger=2)}
    run_bronze(spark, src, settings)
    first = read_table(spark, settings.path("bronze", "livescores")).count()
    records.filter(F.col("offset") % 2 == 1).write.mode("append").parquet(landing)
    run_bronze(spark, src, settings)
    run_bronze(spark, src, settings)  # nothing new: no repeat
    streamed = read_table(spark, settings.path("bronze", "livescores")).select(*KEY_COLS)
    batch = to_bronze(records, "livescores", settings).select(*KEY_COLS)
    assert 0 < first < streamed.count()
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0

    # incremental Silver over the streamed Bronze equals batch Silver
    run_silver_incremental(spark, settings, "livescores", "live_scores")
    inc = read_table(spark, settings.path("silver_stream", "live_scores")).drop(
        "kafka_timestamp", "bronze_ingested_at", "silver_processed_at")
    ref = L.silver(spark, SF_SMALL, "livescores", settings).drop(
        "kafka_timestamp", "bronze_ingested_at", "silver_processed_at").select(*inc.columns)
    assert inc.exceptAll(ref).count() == 0 and ref.exceptAll(inc).count() == 0
    # a scheduled re-run with nothing new landed adds nothing
    before = inc.count()
    run_silver_incremental(spark, settings, "livescores", "live_scores")
    assert read_table(spark, settings.path("silver_stream", "live_scores")).count() == before


def test_waiting_is_not_disturbed_by_other_streams(spark, scratch):
    """Another caller's stream, its failure and a reset of the manager don't touch our wait."""
    from touchline.streaming.bronze import AVAILABLE_NOW, await_all
    spark.range(5).write.parquet(f"{scratch}/in")
    def start(name, trigger):
        return (spark.readStream.schema("id bigint").parquet(f"{scratch}/in").writeStream
                .format("parquet").trigger(**trigger).option("checkpointLocation", f"{scratch}/cp-{name}")
                .start(f"{scratch}/{name}"))
    other = start("other", {"processingTime": "1 second"})
    ours = start("ours", AVAILABLE_NOW)
    ours.awaitTermination(60)
    spark.streams.resetTerminated()
    assert await_all(spark, {"ours": ours})["ours"]
    assert other.isActive
    other.stop()


def test_kafka_options_are_parameters():
    o = kafka_options(StreamSource(kind="kafka", topic="sports.events", servers="b1:9092,b2:9092",
                                   max_per_trigger=500))
    assert o["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert o["subscribe"] == "sports.events" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "500" and o["failOnDataLoss"] == "true"


def test_bronze_keeps_redeliveries_for_the_batch_step(spark, scratch):
    from touchline.operators.snapshot import drop_redeliveries
    settings = L.demo_settings(root=scratch)
    landing = f"{scratch}/landing/events"
    records = demo_records(spark, SF_SMALL, "events")
    records.write.mode("overwrite").parquet(landing)
    run_bronze(spark, {"events": StreamSource(kind="files", path=landing)}, settings)
    out = read_table(spark, settings.path("bronze", "events"))
    distinct = records.select("topic", "partition", "offset").distinct().count()
    assert out.count() == records.count() > distinct
    assert drop_redeliveries(out).count() == distinct


def test_failed_stream_is_raised_and_others_stopped(spark, scratch):
    import pytest
    settings = L.demo_settings(root=scratch)
    good = f"{scratch}/landing/leagues"
    demo_records(spark, SF_SMALL, "leagues").write.mode("overwrite").parquet(good)
    bad = f"{scratch}/landing/broken"
    # broker records whose key is a number: the replay schema (binary key) cannot read them
    spark.range(5).selectExpr("id as key", "cast(id as string) as value").write \
        .mode("overwrite").parquet(bad)
    sources = {"leagues": StreamSource(kind="files", path=good),
               "events": StreamSource(kind="files", path=bad)}
    with pytest.raises(Exception):
        run_bronze(spark, sources, settings, trigger={"processingTime": "1 second"})
    assert not [q for q in spark.streams.active if q.name and q.name.startswith("bronze_")]
