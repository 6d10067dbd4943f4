"""The poller's data steps as operators."""

from touchline.operators import publish as P
from touchline.plans import lineage as L
from touchline.sinks.publish import to_messages

S = L.demo_settings()


def test_message_key_fallbacks(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id bigint, name string")
    keys = sorted(r.key for r in to_messages(df, "t").collect())
    assert keys == ["1", "unknown"]
    given = to_messages(df.withColumn("k", df.name), "t", key="k").collect()
    assert sorted(r.key for r in given) == ["a", "b"]
    # per message: a given key that is null falls back to the id
    some = df.selectExpr("*", "if(id = 1, null, 'x') as k")
    assert sorted(r.key for r in to_messages(some, "t", key="k").collect()) == ["1", "x"]


def test_explode_page_missing_data(spark):
    pages = spark.createDataFrame([(1, '{"data":[{"id":1},{"id":2,"x":{"y":1}}]}'),
                                   (2, '{"message":"quota"}'), (3, '{"data":[]}')],
                                  "page_no int, page string")
    got = [(r.page_no, r.item_position, r.item_json) for r in P.explode_page(pages).collect()]
    assert got == [(1, 0, '{"id":1}'), (1, 1, '{"id":2,"x":{"y":1}}')]


def test_event_fanout_keys_and_metadata(spark):
    import json
    bronze = spark.createDataFrame(
        [("5", '{"id":5,"events":[{"id":"51","type_id":"1"},{"id":"52"}]}', 0, 0)],
        "kafka_key string, raw_json string, kafka_partition int, kafka_offset bigint")
    rows = P.event_fanout(bronze, S).orderBy("event_position").collect()
    assert [r.key for r in rows] == ["5_51", "5_52"]
    msg = json.loads(rows[0].value)
    assert msg["id"] == "51" and msg["_metadata"]["fixture_id"] == 5


def test_upcoming_window(spark):
    rows = [(1, "2024-01-01 10:00:00", 0), (1, "2024-01-01 11:00:00", 1),  # polled twice
            (2, "2024-01-02 10:00:01", 0), (3, "2023-12-31 23:59:59", 0), (4, "soon", 0),
            (5, "2024-01-01 10:00:00", 0), (5, "2024-02-01 10:00:00", 1)]  # postponed
    fx = (spark.createDataFrame(rows, "fixture_id bigint, starting_at string, kafka_offset bigint")
          .selectExpr("*", "timestamp_seconds(kafka_offset) as kafka_timestamp", "0 as kafka_partition"))
    s = L.demo_settings(as_of="2024-01-01 10:00:00")
    got = [(r.fixture_id, r.starting_at) for r in P.upcoming_fixtures(fx, s).collect()]
    assert got == [(1, "2024-01-01 11:00:00")]
