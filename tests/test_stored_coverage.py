"""Coverage over stored Silver: each poll once, no state, narrow shuffles."""

import random

import pytest

from touchline.files import children, exists
from touchline.streaming import coverage as C
from touchline.streaming.bronze import AVAILABLE_NOW

FX = ("fixture_id bigint, league_id int, season_id int, starting_at string, kafka_timestamp timestamp, "
      "kafka_partition int, kafka_offset bigint")
LV = "fixture_id bigint, kafka_timestamp timestamp"


def cover(spark, scratch, fixtures, live, bound="2 days"):
    (spark.createDataFrame(fixtures, "id bigint, at string").selectExpr(
        "id as fixture_id", "1 as league_id", "2024 as season_id", "'x' as starting_at",
        "cast(at as timestamp) as kafka_timestamp", "0 as kafka_partition", "id as kafka_offset")
     .coalesce(1).write.mode("append").parquet(f"{scratch}/fx"))
    (spark.createDataFrame(live, "id bigint, at string").selectExpr(
        "id as fixture_id", "cast(at as timestamp) as kafka_timestamp")
     .coalesce(1).write.mode("append").parquet(f"{scratch}/lv"))
    q = C.start_coverage(spark.readStream.schema(FX).parquet(f"{scratch}/fx"), spark.readStream.schema(LV).parquet(f"{scratch}/lv"),
                         f"{scratch}/out", f"{scratch}/cp", bound, trigger=AVAILABLE_NOW)
    assert q.awaitTermination(180)
    assert not exists(spark, f"{scratch}/cp/state")
    return sorted((r.fixture_id or 0, r.covered) for r in C.settled_polls(spark, f"{scratch}/out/polls").collect())


def test_stored_coverage_gives_each_poll_once(spark, scratch):
    """As the join of streams does (``test_coverage_gives_each_poll_once``)."""
    assert cover(spark, scratch, [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:00:00"), (3, "2024-01-01 10:00:00"),
                                  (None, "2024-01-01 10:00:00")],
                 [(1, "2024-01-01 12:00:00"), (1, "2024-01-01 12:02:00"), (None, "2024-01-01 12:00:00")]) == [(1, True)]
    got = cover(spark, scratch, [(4, "2024-01-08 10:00:00")], [(2, "2024-01-03 09:00:00"), (3, "2024-01-03 11:00:00"),
                                                               (5, "2024-01-08 10:00:00")])
    assert got == [(0, False), (1, True), (2, True), (3, False)]
    assert len(children(spark, f"{scratch}/out/open")) == 1  # only what the last batch left
    # game 5's live score came before its poll, in the time that a later poll can still meet
    got = cover(spark, scratch, [(5, "2024-01-08 09:59:00"), (6, "2024-01-08 08:00:00")], [])  # 6 is older than the watermark
    assert got == [(0, False), (1, True), (2, True), (3, False), (5, True)]
    assert cover(spark, scratch, [(-1, "2024-02-01 00:00:00")], [(-2, "2024-02-01 00:00:00")]) == [
        (0, False), (1, True), (2, True), (3, False), (4, False), (5, True)]


def test_stored_polls_against_brute_force(spark):
    rnd = random.Random(8)
    polls = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, *[rnd.randrange(60)] * 9])) for _ in range(200)]
    live = [(rnd.choice([1, 2, 4, None]), rnd.choice([None, *[rnd.randrange(60)] * 9])) for _ in range(25)]
    fixtures = spark.createDataFrame([(*p, i) for i, p in enumerate(polls)], "fixture_id bigint, s bigint, kafka_offset bigint").selectExpr(
        "fixture_id", "1 as league_id", "2024 as season_id", "'x' as starting_at", "timestamp_seconds(s) as kafka_timestamp",
        "0 as kafka_partition", "kafka_offset")
    scores = spark.createDataFrame(live, "fixture_id bigint, s bigint").selectExpr("fixture_id", "timestamp_seconds(s) as kafka_timestamp")
    for tasks in (None, 3):
        got = C.covered_fixtures(fixtures, scores, "5 seconds", tasks=tasks)
        assert {r.kafka_offset: r.covered for r in got.collect()} == {
            i: p is not None and t is not None and any(g == p and u is not None and t <= u <= t + 5 for g, u in live)
            for i, (p, t) in enumerate(polls)} and got.count() == len(polls)


def test_a_coverage_batch_that_is_run_again_changes_nothing(spark, scratch, monkeypatch):
    real = C.publish_file

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(C, "publish_file", lost)
    with pytest.raises(Exception):
        cover(spark, scratch, [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:00:00")], [(1, "2024-01-01 12:00:00")])
    monkeypatch.setattr(C, "publish_file", real)
    for _ in range(2):
        got = cover(spark, scratch, [], [])
    assert got == [(1, True)]
