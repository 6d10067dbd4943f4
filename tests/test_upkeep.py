"""Compaction of streamed tables, sketches over days, coverage on streams."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from touchline.operators import sketches as K
from touchline.operators.ingest import to_bronze
from touchline.plans import lineage as L
from touchline.sinks import compact as C
from touchline.sinks import tables
from touchline.sinks.snapshots import snapshot
from touchline.sources.demo import demo_records
from touchline.sources.stream import StreamSource
from touchline.sources.tables import read_bronze
from touchline.streaming.bronze import AVAILABLE_NOW, run_bronze
from touchline.streaming.coverage import covered_fixtures
from tests.conftest import SF_SMALL

ID = ["kafka_topic", "kafka_partition", "kafka_offset", "raw_json", "year", "month", "day"]


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture()
def streamed(spark, scratch):
    """Bronze of many small batches: (settings, records, a function that lands more and runs the stream)."""
    s = L.demo_settings(root=scratch, bronze_retention="10s")
    records = demo_records(spark, SF_SMALL, "livescores").coalesce(1).persist()
    landing = f"{scratch}/landing"

    def more(where, files):
        records.where(where).repartition(files).write.mode("append").parquet(landing)
        run_bronze(spark, {"livescores": StreamSource(kind="files", path=landing, max_per_trigger=1)}, s)

    yield s, records, more
    records.unpersist()


def test_compaction_keeps_every_message_once(spark, streamed, monkeypatch):
    s, records, more = streamed
    path = s.path("bronze", "livescores")
    whole = to_bronze(records, "livescores", s).select(*ID)
    schema = whole.schema

    def stream_reader():
        q = (spark.readStream.schema(to_bronze(records, "livescores", s).schema).parquet(path).select(*ID).writeStream
             .format("parquet").trigger(**AVAILABLE_NOW).option("checkpointLocation", f"{s.root}/cp-reader")
             .start(f"{s.root}/reader"))
        assert q.awaitTermination(180)
        return spark.read.schema(schema).parquet(f"{s.root}/reader").select(*ID)

    def batch_reader():
        return read_bronze(spark, path, s).select(*ID)

    first = "offset % 4 < 2"
    more(first, 4)
    seen = to_bronze(records.where(first), "livescores", s).select(*ID)
    assert same(stream_reader(), seen)
    before = max(C.files_per_day(read_bronze(spark, path, s)).values())
    done = C.compact(spark, path, date(2024, 1, 20), file_bytes=1 << 30)
    assert done["read"] > done["files"] and before > 2
    assert same(batch_reader(), seen) and same(stream_reader(), seen)
    per_day = C.files_per_day(read_bronze(spark, path, s))
    assert max(n for d, n in per_day.items() if int(d.split("-")[2]) < 20) == 1

    # late files of compacted days: read beside the version, then taken in by the next one
    more("offset % 4 = 2", 3)
    seen = to_bronze(records.where("offset % 4 < 3"), "livescores", s).select(*ID)
    resolved = batch_reader()
    assert same(resolved, seen)

    def lost(*args, **kw):
        raise RuntimeError("driver lost")

    real = tables.commit
    monkeypatch.setattr(tables, "commit", lost)
    with pytest.raises(RuntimeError):
        C.compact(spark, path, date(2024, 1, 25))
    assert same(batch_reader(), seen)
    monkeypatch.setattr(tables, "commit", real)
    C.compact(spark, path, date(2024, 1, 25))
    assert same(batch_reader(), seen) and same(resolved, seen) and same(stream_reader(), seen)
    again = C.compact(spark, path, date(2024, 1, 25))
    assert again["read"] == 0
    more("offset % 4 = 3", 2)
    assert same(batch_reader(), whole) and same(stream_reader(), whole)


def test_files_that_left_the_log_are_deleted_once_covered(spark, streamed, monkeypatch):
    """The sink's log forgets files after its retention; their rows stay in the compacted table."""
    s, records, more = streamed
    path = s.path("bronze", "livescores")
    more("offset % 2 = 0", 2)
    C.compact(spark, path, date(2024, 3, 1))
    listed = C.listed_files(spark, path)
    monkeypatch.setattr(C, "listed_files", lambda *a: listed[3:])
    done = C.compact(spark, path, date(2024, 3, 1))
    assert done["deleted"] == 3
    rows = C.read_streamed(spark, path).select(*ID)
    assert same(rows, to_bronze(records.where("offset % 2 = 0"), "livescores", s).select(*ID))
    assert not any(C.exists(spark, f"{path}/{f}") for f in listed[:3])
    assert C.exists(spark, f"{path}/{listed[3]}")


def test_the_sink_gets_its_retention(spark, scratch):
    from touchline.sinks.tables import stream_append
    rows = spark.readStream.format("rate").load().withColumns(
        {c: F.lit(1) for c in ("year", "month", "day")})
    q = stream_append(rows, f"{scratch}/t", f"{scratch}/cp", retention="7d")
    q.stop()


def test_latency_sketches_over_days(spark):
    s = L.demo_settings()
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("data_type"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("kafka_timestamp"))
    bronze = rows.withColumns({
        "bronze_ingested_at": F.timestamp_seconds(F.unix_seconds("kafka_timestamp") + F.hash("kafka_timestamp") % 5000),
        "raw_json": F.when(F.col("data_type") == "a", F.concat(
            F.lit('{"_metadata":{"fetched_at":"'), F.date_format("kafka_timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"}}')))})
    daily = K.daily_freshness(bronze)
    assert daily.count() == 28
    for first, last in ((None, None), ("2024-01-03", "2024-01-05")):
        got = {r.data_type: r for r in K.freshness_over(daily, first, last).collect()}
        part = bronze.where("data_type = 'a'")
        if first:
            part = part.where(F.to_date("kafka_timestamp").between(first, last))
        exact = sorted(r[0] for r in part.select(F.unix_seconds("bronze_ingested_at") - F.unix_seconds("kafka_timestamp")).collect())
        assert got["a"].messages == len(exact)
        for p, value in ((0.5, got["a"].latency_p50_s), (0.95, got["a"].latency_p95_s)):
            rank = sum(v <= value for v in exact) / len(exact)
            assert abs(rank - p) <= 0.0265, (p, rank)
        assert got["b"].latency_p50_s is None and got["b"].latency_p95_s is None
    assert s.as_of


def test_games_over_weeks(spark):
    rows = spark.range(30_000).select(
        (F.col("id") % 7000).alias("fixture_id"), F.lit(2).alias("events_count"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("kafka_timestamp"))
    got = K.fetches_over(K.daily_fetches(rows)).collect()
    exact = {r[0]: r[1] for r in rows.groupBy(F.date_trunc("week", "kafka_timestamp").cast("date"))
             .agg(F.count_distinct("fixture_id")).collect()}
    assert sum(r.messages for r in got) == 30_000 and sum(r.events for r in got) == 60_000
    for r in got:
        assert abs(r.games - exact[r.period]) <= 0.06 * exact[r.period]


def test_coverage_gives_each_poll_once(spark, scratch):
    """Covered at once, or not covered after the bound; a live score after the bound does not count."""
    fx = ("fixture_id bigint, league_id int, season_id int, starting_at string, kafka_timestamp timestamp, "
          "kafka_partition int, kafka_offset bigint")
    lv = "fixture_id bigint, kafka_timestamp timestamp"

    def land(fixtures, live):
        (spark.createDataFrame(fixtures, "id bigint, at string").selectExpr(
            "id as fixture_id", "1 as league_id", "2024 as season_id", "'x' as starting_at",
            "cast(at as timestamp) as kafka_timestamp", "0 as kafka_partition", "id as kafka_offset")
         .coalesce(1).write.mode("append").parquet(f"{scratch}/fx"))
        (spark.createDataFrame(live, "id bigint, at string").selectExpr(
            "id as fixture_id", "cast(at as timestamp) as kafka_timestamp")
         .coalesce(1).write.mode("append").parquet(f"{scratch}/lv"))
        q = (covered_fixtures(spark.readStream.schema(fx).parquet(f"{scratch}/fx"),
                              spark.readStream.schema(lv).parquet(f"{scratch}/lv"), "2 days")
             .writeStream.format("parquet").trigger(**AVAILABLE_NOW)
             .option("checkpointLocation", f"{scratch}/cp").start(f"{scratch}/out"))
        assert q.awaitTermination(180)
        return sorted((r.fixture_id, r.covered) for r in spark.read.parquet(f"{scratch}/out").collect())

    assert land([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:00:00"), (3, "2024-01-01 10:00:00")],
                [(1, "2024-01-01 12:00:00"), (1, "2024-01-01 12:02:00")]) == [(1, True)]
    # game 2 starts within the bound, game 3 after it; the second side then moves on
    got = land([(4, "2024-01-08 10:00:00")], [(2, "2024-01-03 09:00:00"), (3, "2024-01-03 11:00:00"),
                                              (5, "2024-01-08 10:00:00")])
    assert got == [(1, True), (2, True), (3, False)]
    assert land([(-1, "2024-02-01 00:00:00")], [(-2, "2024-02-01 00:00:00")]) == got + [(4, False)]


def test_silver_lookback_prunes_days_of_the_record_clock(spark, scratch):
    from touchline.sinks.tables import write_table
    from touchline.sources.tables import read_silver
    s = L.demo_settings(root=scratch)
    path = s.path("silver", "fixtures")
    write_table(L.silver(spark, SF_SMALL, "fixtures", s), path)
    df = read_silver(spark, path, s, days_back=10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert 0 < df.count() < read_silver(spark, path, s, days_back=None).count()
    assert snapshot(spark, path).version == 1
