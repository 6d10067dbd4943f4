"""Repeated polls: newest snapshot per key; exact re-deliveries."""

import datetime as dt

from touchline.operators.snapshot import duplicate_report, latest_snapshot

T0 = dt.datetime(2024, 1, 1)


def test_latest_by_broker_order(spark):
    rows = [(1, "a", T0, 0, 5), (1, "b", T0 + dt.timedelta(minutes=1), 0, 6),
            (1, "c", T0 + dt.timedelta(minutes=1), 1, 2),   # same time, later partition
            (2, "x", T0, 0, 1)]
    df = spark.createDataFrame(rows, "fixture_id bigint, v string, kafka_timestamp timestamp, "
                                     "kafka_partition int, kafka_offset bigint")
    got = {r.fixture_id: r.v for r in latest_snapshot(df, ["fixture_id"]).collect()}
    assert got == {1: "c", 2: "x"}
    assert latest_snapshot(df, ["fixture_id"]).columns == df.columns


def test_snapshot_reduces_before_shuffle(spark):
    df = spark.createDataFrame([(1, "a", T0, 0, 5)], "fixture_id bigint, v string, "
                               "kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint")
    plan = latest_snapshot(df, ["fixture_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_duplicate_report(spark):
    df = spark.createDataFrame([("t", 0, 1), ("t", 0, 1), ("t", 0, 2), ("t", 1, 1)],
                               "kafka_topic string, kafka_partition int, kafka_offset bigint")
    got = [(r.kafka_partition, r.kafka_offset, r.copies) for r in duplicate_report(df).collect()]
    assert got == [(0, 1, 2)]
