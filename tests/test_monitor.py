"""Monitoring and quality aggregates on small hand-made Bronze rows."""

import datetime as dt

from touchline.operators import monitor as M
from touchline.operators import quality as Q
from touchline.plans import lineage as L

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
COLS = ("kafka_topic string, kafka_partition int, kafka_offset bigint, "
        "kafka_timestamp timestamp, bronze_ingested_at timestamp, data_type string, "
        "raw_json string")


def rows(spark):
    def r(part, off, minutes, fetched_shift, text=None):
        ts = T0 + dt.timedelta(minutes=minutes)
        fetched = (ts + dt.timedelta(seconds=fetched_shift)).strftime("%Y-%m-%dT%H:%M:%S")
        body = text if text is not None else f'{{"id":1,"_metadata":{{"fetched_at":"{fetched}"}}}}'
        return ("t", part, off, ts, ts + dt.timedelta(seconds=5), "x", body)
    return spark.createDataFrame([r(0, 0, 0, -2), r(0, 1, 10, -2), r(0, 4, 70, 3),
                                  r(1, 7, 5, -2, text="")], COLS)


def test_offset_gaps(spark):
    got = {r.kafka_partition: (r.offsets_seen, r.offsets_missing)
           for r in M.offset_gaps(rows(spark)).collect()}
    assert got == {0: (3, 2), 1: (1, 0)}


def test_throughput_hour_buckets(spark):
    got = sorted((r.window_start_epoch, r.messages) for r in M.throughput(rows(spark)).collect())
    start = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    assert got == [(start, 3), (start + 3600, 1)]


def test_freshness_and_clock_checks(spark):
    s = L.demo_settings(as_of="2024-01-01 12:00:00")
    f = M.freshness(rows(spark), s).first()
    assert f.messages == 4 and f.min_latency_s == 2 and f.max_latency_s == 7
    assert f.seconds_since_last == 3600 - 600
    assert (f.min_latency_s, f.latency_p50_s, f.latency_p95_s) == (2, 7, 7)
    c = Q.timestamp_checks(rows(spark)).first()
    assert c.missing_fetched_at == 1 and c.fetched_after_broker == 1
    assert c.broker_after_ingest == 0


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "a int, b string")
    got = {r.column_name: (r.rows, r.null_count) for r in Q.null_profile(df).collect()}
    assert got == {"a": (3, 1), "b": (3, 2)}


def test_match_coverage_takes_the_newest_fixture_poll(spark):
    """A match postponed past the clock has not started, whatever an earlier poll said."""
    def poll(fixture, league, start, minute):
        return (fixture, league, 2024, start, T0 + dt.timedelta(minutes=minute), 0, minute)
    fixtures = spark.createDataFrame(
        [poll(1, 9, "2024-01-01 08:00:00", 0), poll(1, 1, "2024-03-01 08:00:00", 5),
         poll(2, 9, "2024-03-01 08:00:00", 0), poll(2, 1, "2024-01-01 08:00:00", 5),
         poll(3, 1, "2024-01-01 09:00:00", 0), poll(3, 1, "2024-01-01 09:00:00", 7)],
        "fixture_id bigint, league_id int, season_id int, starting_at string, "
        "kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint")
    live = spark.createDataFrame([(1,), (3,), (3,)], "fixture_id bigint")
    s = L.demo_settings(as_of="2024-01-01 12:00:00")
    got = [tuple(r) for r in M.match_coverage(fixtures, live, s).collect()]
    assert got == [(1, 2024, 2, 1, 0.5)]
