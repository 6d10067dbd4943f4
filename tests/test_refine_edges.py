"""Silver parsing on hand-made edge rows (FIXTURES part D)."""

from touchline.config import Settings
from touchline.operators.refine import (
    REASON, parsed_with_reason, refine_events, refine_live_scores,
)
from touchline.schemas import LIVE_SCORE_DDL

BRONZE_COLS = ("kafka_key string, raw_json string, kafka_timestamp timestamp, "
               "kafka_partition int, kafka_offset bigint, bronze_ingested_at timestamp, "
               "year int, month int, day int")


def bronze(spark, texts, key="1"):
    rows = [(key, t, None, 0, i, None, 2024, 1, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, BRONZE_COLS)


def reasons(spark, texts):
    p = parsed_with_reason(bronze(spark, texts), LIVE_SCORE_DDL)
    return {r["raw_json"]: r[REASON] for r in p.select("raw_json", REASON).collect()}


def test_dead_letter_reasons(spark):
    got = reasons(spark, ["{bad", "", "null", "[]", '[{"id":1},{"id":2}]',
                          '{"id":"7","name":"c"}', '{"id":7.9,"name":"c"}',
                          '{"id":1,"state_id":"x"}', '{"id":99999999999}', '{"id":1}'])
    assert got["{bad"] == "unparsable"
    assert got[""] == "empty"
    assert got["null"] == "unparsable"
    assert got["[]"] == "unparsable"
    assert got['[{"id":1},{"id":2}]'] == "unparsable"
    assert got['{"id":"7","name":"c"}'] == "no_id"
    assert got['{"id":7.9,"name":"c"}'] == "no_id"
    assert got['{"id":1,"state_id":"x"}'] == "partial"
    assert got['{"id":99999999999}'] is None
    assert got['{"id":1}'] is None


def test_bad_rows_leave_silver_unless_kept(spark):
    texts = ["{bad", "", '{"id":"7"}', '{"id":1,"state_id":"x"}', '{"id":2,"state_id":3}']
    default = refine_live_scores(bronze(spark, texts), Settings())
    assert sorted(r.fixture_id for r in default.collect()) == [1, 2]
    kept = refine_live_scores(bronze(spark, texts), Settings(keep_bad_rows=True))
    assert kept.count() == 5


def test_partial_row_keeps_good_fields(spark):
    r = refine_live_scores(bronze(spark, ['{"id":1,"state_id":"x","name":"a"}']),
                           Settings()).first()
    assert r.fixture_id == 1 and r.state_id is None and r.fixture_name == "a"
    assert r.is_live is False and r.is_finished is False


def test_big_id_is_kept(spark):
    r = refine_live_scores(bronze(spark, ['{"id":99999999999}']), Settings()).first()
    assert r.fixture_id == 99999999999


def test_positions_and_missing_arrays(spark):
    texts = ['{"id":1,"participants":[{"id":5,"name":"A"}]}', '{"id":2,"state_id":3}',
             '{"id":3}', '{"id":4,"starting_at":"soon"}',
             '{"id":5,"starting_at":"2024-01-02T15:30:00","scores":[{"score":{"goals":2}},'
             '{"score":{"goals":1}}],"events":[{"id":"1"},{"id":"2"}]}']
    rows = {r.fixture_id: r for r in refine_live_scores(bronze(spark, texts), Settings()).collect()}
    assert rows[1].home_team == "A" and rows[1].away_team is None
    assert rows[2].home_score is None and rows[2].total_goals is None and rows[2].is_finished
    assert rows[3].events_count is None
    assert rows[4].match_date is None
    assert rows[5].total_goals == 3 and rows[5].score_difference == 1
    assert rows[5].events_count == 2 and str(rows[5].match_date) == "2024-01-02"


def test_event_codes_minutes_and_fixture_fallback(spark):
    texts = ['{"id":1,"type_id":7}', '{"id":2,"type_id":8}', '{"id":3}',
             '{"id":4,"type_id":1,"fixture_id":5}',
             '{"id":9,"_metadata":{"fixture_id":77},"minute":45,"extra_minute":null}',
             '{"id":10,"extra_minute":2}', '{"id":11,"minute":90,"extra_minute":4,"type_id":5}']
    ev = {r.event_id: r for r in refine_events(bronze(spark, texts, key="88_1"),
                                               Settings()).collect()}
    assert ev[1].event_type == "OTHER" and ev[2].event_type == "OTHER"
    assert ev[3].event_type == "OTHER" and ev[4].event_type == "GOAL"
    assert ev[4].fixture_id == 5
    assert ev[9].fixture_id == 77 and ev[9].total_minutes == 45
    assert ev[10].total_minutes is None
    assert ev[11].total_minutes == 94 and ev[11].event_type == "YELLOW_CARD"
    # the key prefix is the last fallback
    assert ev[1].fixture_id == 88
    parity = {r.event_id: r for r in refine_events(
        bronze(spark, texts), Settings(event_fixture_fallback=False)).collect()}
    assert parity[9].fixture_id is None
