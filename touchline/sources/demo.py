"""Demo feeds: football messages derived from the supplied test tables.

The test tables hold no football data, so fixtures, live-score polls, match events and
leagues are derived from ``orders``, ``events`` and ``region`` with integer arithmetic
only (the same rules are written in SQL in ``touchline.oracle`` and give equal rows in
DuckDB). The payloads are serialised with ``to_json`` and shaped as Kafka records
(``key, value, topic, partition, offset, timestamp``), so the real Bronze, Silver and Gold
operators run on them. Everything here is lazy and scales with the input tables.

Generation rules (not filters; every input row produces messages):

* one fixture message per order, and for every third fixture one before it, which names a later
  kick-off (so that only newest polls are right); ``league = orderkey % 5``, ``season = year(orderdate)``,
  state 3 (finished) for status F, 2 (live) for O, 1 (not started) otherwise;
* live-score messages only for started games (state 2 or 3), ``1 + fixture_id % 3`` polls
  per game, 30 minutes apart; only the last poll carries the final state and score, the
  earlier ones read live and 0-0. The (historical) games are replayed through the broker
  over the 30 days from ``REPLAY_START``; a fixture message precedes its first poll by a day;
* some earlier polls are damaged the way a flaky feed damages them: empty text,
  non-JSON text, a quoted id, a non-numeric state (``fixture_id % 29`` = 1..4);
* 50 events in a row belong to one fixture; one event message per ``events`` row and poll (``1 + event_id % 2`` polls, 2 minutes
  apart) with its fixture id only under ``_metadata`` (as the producer writes it); the
  first poll of every 50th event is delivered twice with the same offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import TOPICS

PARTITIONS = 3  # partitions per demo topic; the partition is the fixture id modulo 3
POLL_MINUTES = 30
EVENT_POLL_MINUTES = 2
EVENTS_PER_FIXTURE = 50
FIXTURE_POLL_HOURS = 6  # every third fixture is polled twice, and its kick-off moves in between
MOVED_DAYS = 3
# The historical matches are replayed through the broker over 30 days from this instant
# (the month the ``events`` table covers): fixture f is first polled (f % 720) hours in.
REPLAY_START = "2024-01-01 00:00:00"
REPLAY_HOURS = 720


def _replay_ts(fixture_id: Column) -> Column:
    return F.timestamp_add("HOUR", (fixture_id % REPLAY_HOURS).cast("int"),
                           F.lit(REPLAY_START).cast("timestamp"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """The few source columns dealt over the session's shuffle partitions: a table may be one file
    with one row group, and its messages are many times as wide as the columns they are made from."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _ts_plus(ts: Column, unit: str, qty: Column) -> Column:
    return F.timestamp_add(unit, qty, ts)


def _team_name(team_id: Column) -> Column:
    return F.concat(F.lit("Team "), team_id.cast("string"))


def demo_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One football match per order (FIXTURES part C, ``demo_matches``)."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                     "o_orderdate"), "o_orderkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    home_id = cust % 20
    away_id = (cust % 20 + 1 + key % 19) % 20
    return o.select(
        key.cast("bigint").alias("fixture_id"),
        F.lit(1).cast("int").alias("sport_id"),
        (key % 5).cast("int").alias("league_id"),
        F.year("o_orderdate").cast("int").alias("season_id"),
        (key % 3).cast("int").alias("stage_id"),
        F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 2)
         .otherwise(1).cast("int").alias("state_id"),
        F.col("o_orderdate").cast("timestamp").alias("starting_ts"),
        home_id.cast("bigint").alias("home_team_id"),
        away_id.cast("bigint").alias("away_team_id"),
        _team_name(home_id).alias("home_team"),
        _team_name(away_id).alias("away_team"),
        F.when(key % 17 == 0, F.lit(None)).otherwise(cust % 6).cast("int").alias("home_score"),
        (key % 4).cast("int").alias("away_score"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(key % 7).cast("int").alias("events_count"),
        (cust % 50).cast("bigint").alias("venue_id"),
        (key % 2 == 0).alias("has_odds"),
    )


def demo_match_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match event per ``events`` row (FIXTURES part C, ``demo_match_events``)."""
    e = spread(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "event_id")
    eid, uid = F.col("event_id"), F.col("user_id")
    return e.select(
        eid.cast("bigint").alias("event_id"),
        F.expr(f"event_id div {EVENTS_PER_FIXTURE}").cast("bigint").alias("fixture_id"),
        (eid % 9).cast("int").alias("type_id"),
        (eid * 13 % 90).cast("int").alias("minute"),
        F.when(eid % 4 == 0, F.lit(None)).otherwise(eid % 6).cast("int").alias("extra_minute"),
        uid.cast("bigint").alias("player_id"),
        F.when(uid % 13 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("Player "), uid.cast("string"))).alias("player_name"),
        F.col("ts").cast("timestamp").alias("created_ts"),
    )


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _plain(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _metadata(kind: str, fetched: Column, **more: Column) -> Column:
    fields = [F.lit("demo").alias("source"), F.lit(kind).alias("type")]
    fields += [c.alias(k) for k, c in more.items()]
    fields += [_iso(fetched).alias("fetched_at"), F.lit("v3").alias("api_version")]
    return F.struct(*fields)


def _participants() -> Column:
    return F.array(
        F.struct(F.col("home_team_id").alias("id"), F.col("home_team").alias("name")),
        F.struct(F.col("away_team_id").alias("id"), F.col("away_team").alias("name")),
    )


def _fetched_at(kafka_ts: Column, fixture_id: Column) -> Column:
    # The poller's clock runs 2 s behind the broker, except for every 31st fixture,
    # where it runs 7 s ahead (a clock-skew case for the timestamp checks).
    return F.when(fixture_id % 31 == 0, _ts_plus(kafka_ts, "SECOND", F.lit(7))) \
            .otherwise(_ts_plus(kafka_ts, "SECOND", F.lit(-2)))


LOG_ORDER = ("kafka_ts", "kafka_partition", "kafka_offset")


def _record(key: Column, value: Column, topic: str, partition: Column | None = None, offset: Column | None = None,
            ts: Column | None = None) -> list[Column]:
    ts, partition, offset = (F.col(c) if given is None else given for c, given in zip(LOG_ORDER, (ts, partition, offset)))
    return [key.cast("binary").alias("key"), value.cast("binary").alias("value"),
            F.lit(topic).alias("topic"), partition.cast("int").alias("partition"),
            offset.cast("bigint").alias("offset"), ts.alias("timestamp")]


def live_score_polls(matches: DataFrame) -> DataFrame:
    """Poll rows of started games: the state and score as each poll saw them."""
    fid = F.col("fixture_id")
    started = matches.filter(F.col("state_id").isin(2, 3))
    polls = started.withColumn("n_polls", (fid % 3 + 1).cast("int")) \
                   .withColumn("poll", F.explode(F.sequence(F.lit(0), F.col("n_polls") - 1)))
    final = F.col("poll") == F.col("n_polls") - 1
    kafka_ts = _ts_plus(_replay_ts(fid), "MINUTE", F.col("poll") * POLL_MINUTES)
    return polls.select(
        "fixture_id", "sport_id", "league_id", "season_id", "starting_ts",
        "home_team_id", "away_team_id", "home_team", "away_team", "poll", "n_polls",
        F.when(final, F.col("state_id")).otherwise(2).cast("int").alias("state_id"),
        F.when(final, F.col("home_score")).otherwise(0).cast("int").alias("home_score"),
        F.when(final, F.col("away_score")).otherwise(0).cast("int").alias("away_score"),
        "events_count",
        (fid * 3 + F.col("poll")).cast("bigint").alias("kafka_offset"),
        kafka_ts.alias("kafka_ts"),
        (fid % 29).alias("damage"),
    )


def live_score_payload() -> Column:
    """The live-score object of the API (with ``_metadata``) as a struct."""
    n = F.col("events_count")
    events = (F.when(n > 0, F.transform(
                  F.sequence(F.lit(1), n),
                  lambda i: F.create_map(
                      F.lit("id"), (F.col("fixture_id") * 10 + i).cast("string"),
                      F.lit("type_id"), (i % 9).cast("string"),
                      F.lit("minute"), (i * 11 % 90).cast("string"))))
              .when(n == 0, F.array().cast("array<map<string,string>>")))
    scores = F.array(F.struct(F.struct(F.col("home_score").alias("goals")).alias("score")),
                     F.struct(F.struct(F.col("away_score").alias("goals")).alias("score")))
    return F.struct(
        F.col("fixture_id").alias("id"), "sport_id", "league_id", "season_id",
        F.concat_ws(" vs ", "home_team", "away_team").alias("name"),
        _plain(F.col("starting_ts")).alias("starting_at"), "state_id",
        _participants().alias("participants"), scores.alias("scores"), events.alias("events"),
        _metadata("live_score", _fetched_at(F.col("kafka_ts"), F.col("fixture_id")))
        .alias("_metadata"),
    )


def damaged(text: Column) -> Column:
    """Damage an earlier poll (never the final one) of every 29th-class fixture."""
    early = (F.col("poll") == 0) & (F.col("n_polls") > 1)
    d = F.col("damage")
    return (F.when(early & (d == 1), F.lit(""))
            .when(early & (d == 2), F.concat(F.lit("not json: "), F.col("fixture_id").cast("string")))
            .when(early & (d == 3), F.regexp_replace(text, r'^\{"id":(\d+)', '{"id":"$1"'))
            .when(early & (d == 4), F.regexp_replace(text, r'"state_id":2,', '"state_id":"x",'))
            .otherwise(text))


def live_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_score_polls(demo_matches(spark, sf_dir)).withColumn("kafka_partition", F.col("fixture_id") % PARTITIONS)


def live_score_records(polls: DataFrame) -> DataFrame:
    value = damaged(F.col("json"))
    return polls.withColumn("json", F.to_json(live_score_payload())).select(
        *_record(F.col("fixture_id").cast("string"), value, TOPICS["livescores"]))


def fixture_polls(matches: DataFrame) -> DataFrame:
    """Poll rows of fixtures: of two polls, the first names a kick-off three days later."""
    fid = F.col("fixture_id")
    polls = matches.withColumn("n_polls", F.when(fid % 3 == 0, 2).otherwise(1)).withColumn(
        "poll", F.explode(F.sequence(F.lit(0), F.col("n_polls") - 1)))
    left = F.col("n_polls") - 1 - F.col("poll")
    return polls.withColumns({
        "starting_ts": F.when(left > 0, _ts_plus(F.col("starting_ts"), "DAY", F.lit(MOVED_DAYS))).otherwise(F.col("starting_ts")),
        "kafka_offset": (fid * 2 + F.col("poll")).cast("bigint"),
        "kafka_ts": _ts_plus(_ts_plus(_replay_ts(fid), "DAY", F.lit(-1)), "HOUR", -left * FIXTURE_POLL_HOURS)})


def fixture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_polls(demo_matches(spark, sf_dir)).withColumn("kafka_partition", F.col("fixture_id") % PARTITIONS)


def fixture_records(polls: DataFrame) -> DataFrame:
    kafka_ts = F.col("kafka_ts")
    payload = F.struct(
        F.col("fixture_id").alias("id"), "sport_id", "league_id", "season_id", "stage_id",
        "state_id", F.concat_ws(" vs ", "home_team", "away_team").alias("name"),
        _plain(F.col("starting_ts")).alias("starting_at"),
        F.when(F.col("state_id") == 3, F.lit("Game ended")).alias("result_info"),
        "venue_id", F.lit(90).alias("length"), F.lit(False).alias("placeholder"), "has_odds",
        _participants().alias("participants"),
        _metadata("fixture", _fetched_at(kafka_ts, F.col("fixture_id"))).alias("_metadata"),
    )
    return polls.select(*_record(F.col("fixture_id").cast("string"), F.to_json(payload), TOPICS["fixtures"]))


def event_polls(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    polled = events.withColumn("poll", F.explode(F.sequence(F.lit(0), (eid % 2).cast("int"))))
    copies = F.when((eid % 50 == 0) & (F.col("poll") == 0), 2).otherwise(1)
    return polled.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))) \
                 .withColumn("kafka_offset", (eid * 2 + F.col("poll")).cast("bigint")) \
                 .withColumn("kafka_ts", _ts_plus(F.col("created_ts"), "MINUTE",
                                                  F.col("poll") * EVENT_POLL_MINUTES))


def event_payload() -> Column:
    minute = F.col("minute")
    return F.struct(
        F.col("event_id").alias("id"), "type_id",
        F.when(minute < 45, F.lit("1st-half")).otherwise(F.lit("2nd-half")).alias("section"),
        "minute", "extra_minute",
        F.when(F.col("type_id").between(1, 3),
               F.concat((minute % 3).cast("string"), F.lit("-"), (minute % 2).cast("string")))
         .alias("result"),
        "player_id", "player_name",
        _plain(F.col("created_ts")).alias("created_at"),
        _metadata("event", _fetched_at(F.col("kafka_ts"), F.col("fixture_id")),
                  fixture_id=F.col("fixture_id")).alias("_metadata"),
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_polls(demo_match_events(spark, sf_dir)).withColumn("kafka_partition", F.col("fixture_id") % PARTITIONS)


def event_records(polls: DataFrame) -> DataFrame:
    key = F.concat_ws("_", F.col("fixture_id").cast("string"), F.col("event_id").cast("string"))
    return polls.select(*_record(key, F.to_json(event_payload()), TOPICS["events"]))


def league_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        "r_regionkey", "r_name", F.lit("2023-12-01 00:00:00").cast("timestamp").alias("kafka_ts"),
        (F.col("r_regionkey") % PARTITIONS).alias("kafka_partition"), F.col("r_regionkey").alias("kafka_offset"))


def league_records(rows: DataFrame) -> DataFrame:
    ts = F.lit("2023-12-01 00:00:00").cast("timestamp")
    payload = F.struct(F.col("r_regionkey").cast("bigint").alias("id"),
                       F.concat(F.lit("League "), F.col("r_name")).alias("name"),
                       _metadata("league", ts).alias("_metadata"))
    return rows.select(*_record(F.col("r_regionkey").cast("string"), F.to_json(payload), TOPICS["leagues"]))


LATE_CLASS = (41, 7)  # fixtures f with f % 41 = 7 have messages that arrive after all others
LATE_OFFSETS = 10**12
# Minutes from the first poll of the messages that arrive late; the last one is new at the end of the replay.
LATE_MINUTES = (-90, -85, -60, -20, 10)
FRESH_FROM = "2024-02-02 00:00:00"


def late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live-score records that land after all others: polls from before and around the first poll of some
    started games, a copy of that poll, and one poll after the replay."""
    every, at = LATE_CLASS
    started = demo_matches(spark, sf_dir).where(F.col("state_id").isin(2, 3)
                                                & (F.col("fixture_id") % every == at))
    fid = F.col("fixture_id")
    fresh = _ts_plus(F.lit(FRESH_FROM).cast("timestamp"), "MINUTE", (fid % 60).cast("int"))
    times = F.array(*[_ts_plus(_replay_ts(fid), "MINUTE", F.lit(m)) for m in LATE_MINUTES], fresh)
    polls = started.select("fixture_id", F.posexplode(times).alias("nth", "ts"))
    late = polls.select(*_record(fid.cast("string"), F.to_json(F.struct(fid.alias("id"))), TOPICS["livescores"],
                                 fid % PARTITIONS, F.lit(LATE_OFFSETS) + fid * 8 + F.col("nth"), F.col("ts")))
    first = demo_records(spark, sf_dir, "livescores").where(
        (F.col("offset") % 3 == 0) & ((F.col("offset") / 3).cast("bigint") % every == at))
    return late.unionByName(first)


# Per data type: the source table, its rows with what a message is made from, and their records.
FEEDS = {
    "fixtures": ("orders", fixture_rows, fixture_records),
    "livescores": ("orders", live_score_rows, live_score_records),
    "events": ("events", event_rows, event_records),
    "leagues": ("region", league_rows, league_records),
}


def demo_records(spark: SparkSession, sf_dir: str, data_type: str) -> DataFrame:
    """Kafka-shaped records of one data type, derived from the test tables."""
    _, rows, records = FEEDS[data_type]
    return records(rows(spark, sf_dir))


ROWS_PER_FILE = 1 << 17  # source rows whose messages make one stretch of the log


def log_stretches(spark: SparkSession, sf_dir: str, data_type: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``demo_records`` as contiguous, time-ordered stretches of the log, one per task.

    Their number grows with the input, so that a stretch always fits a task's memory. The few columns that
    messages are made from are dealt out and sorted, and the texts are written out of the sorted rows: they
    are made once and never shuffled. Range partitioning (sampled bounds) splits a hot day
    over several stretches instead of handing it to one task.
    """
    source, rows, records = FEEDS[data_type]
    n = -(-table(spark, sf_dir, source).count() // rows_per_file)
    stretches = (rows(spark, sf_dir).repartitionByRange(max(n, spark.sparkContext.defaultParallelism), *LOG_ORDER)
                 .sortWithinPartitions(*LOG_ORDER))
    return records(stretches)
