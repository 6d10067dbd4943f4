"""Declared schemas of the messages and of the Kafka record (no inference anywhere).

Ids of entities (fixtures, events, teams, players, venues) are ``bigint``: an id above
2^31-1 would parse to NULL under ``int``. Codes (sport, league, season, stage, state,
type) stay ``int``. ``_corrupt_record`` is carried so bad messages can be routed to the
dead-letter table instead of vanishing as rows of NULLs.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

_PARTICIPANTS = "array<struct<id: bigint, name: string>>"

FIXTURE_DDL = (
    "id bigint, sport_id int, league_id int, season_id int, stage_id int, state_id int, "
    "name string, starting_at string, result_info string, venue_id bigint, length int, "
    f"placeholder boolean, has_odds boolean, participants {_PARTICIPANTS}, "
    "_metadata map<string, string>"
)

LIVE_SCORE_DDL = (
    "id bigint, sport_id int, league_id int, season_id int, name string, starting_at string, "
    f"state_id int, participants {_PARTICIPANTS}, "
    "scores array<struct<score: struct<goals: int>>>, "
    "events array<map<string, string>>, _metadata map<string, string>"
)

EVENT_DDL = (
    "id bigint, fixture_id bigint, type_id int, section string, minute int, extra_minute int, "
    "result string, player_id bigint, player_name string, related_player_id bigint, "
    "related_player_name string, created_at string, _metadata map<string, string>"
)

LEAGUE_DDL = "id bigint, name string, _metadata map<string, string>"

# A page of the REST API: the objects of ``data`` are kept as JSON text each.
PAGE_DDL = "data array<string>"

SCHEMAS = {
    "fixtures": FIXTURE_DDL,
    "livescores": LIVE_SCORE_DDL,
    "events": EVENT_DDL,
    "leagues": LEAGUE_DDL,
}


def with_corrupt(ddl: str) -> str:
    """The message schema plus the ``_corrupt_record`` text column (DDL text)."""
    return f"{ddl}, {CORRUPT} string"


def data_fields(ddl: str) -> list[str]:
    """Top-level field names of a DDL text (commas inside ``<...>`` are skipped)."""
    names, depth, start = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        elif ch == "," and depth == 0:
            names.append(ddl[start:i].strip().split()[0].rstrip(":"))
            start = i + 1
    return names


# The record a Kafka source yields (and the replay files hold).
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# A Bronze table row.
BRONZE_DDL = (
    "kafka_key string, raw_json string, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_timestamp timestamp, bronze_ingested_at timestamp, "
    "data_type string, bronze_version string, year int, month int, day int"
)
