"""Silver: parse raw JSON against declared schemas, flatten, derive, route bad rows.

One ``from_json`` per row, produced by a one-row generator so that neither the field
extraction nor any filter on parsed fields re-evaluates it (see ``parse_json``).
Everything is narrow: no shuffle in this module.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.config import QUALITY_SCORE, STATE_FINISHED, STATE_LIVE, Settings
from touchline.functions.clock import now
from touchline.functions.codes import event_type, is_state
from touchline.functions.dates import safe_date, safe_hour
from touchline.schemas import (
    CORRUPT, EVENT_DDL, FIXTURE_DDL, LEAGUE_DDL, LIVE_SCORE_DDL, SCHEMAS, with_corrupt,
)

MSG = "msg"
REASON = "bad_reason"
TARGET = "target"
ROWS, LETTERS = "rows", "letters"
# Columns carried from Bronze into every Silver table. The three broker columns order
# repeated snapshots (latest_snapshot); the reference keeps only the ingest time.
CARRIED = ["kafka_timestamp", "kafka_partition", "kafka_offset", "bronze_ingested_at"]
PARTS = ["year", "month", "day"]

# Dead-letter reasons, in order of precedence.
EMPTY, UNPARSABLE, NO_ID, PARTIAL = "empty", "unparsable", "no_id", "partial"
DROPPED_REASONS = (EMPTY, UNPARSABLE, NO_ID)


def parse_json(bronze: DataFrame, ddl: str, text: str = "raw_json") -> DataFrame:
    """Add the parsed message struct ``msg`` (permissive: bad text never fails the job).

    The struct comes out of a one-row generator (``inline`` of a one-element array). A
    filter on a generator's output cannot be pushed below it, so every later filter on a
    parsed field (bad rows, finished, live, event kind) stays above the parse. Through a
    plain projection Catalyst would substitute the ``from_json`` call into each pushed-down
    filter and parse the same text once per filter.
    """
    schema = with_corrupt(ddl)
    parsed = F.from_json(F.col(text), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return bronze.select(*bronze.columns,
                         F.inline(F.array(F.struct(parsed.alias(MSG)))))


def bad_reason(text: str = "raw_json", id_field: str = "id") -> Column:
    """Why a parsed message is bad, or NULL when it is good.

    ``empty``: no struct at all (empty text); ``unparsable``: the text is no JSON object,
    so no field could be read; ``no_id``: the key field is missing or of the wrong type;
    ``partial``: the id is there but some field did not parse. The object test runs only
    for rows without an id (CASE branches are evaluated in order).
    """
    msg = F.col(MSG)
    return (F.when(msg.isNull(), F.lit(EMPTY))
            .when(msg[id_field].isNull() & F.json_object_keys(F.col(text)).isNull(),
                  F.lit(UNPARSABLE))
            .when(msg[id_field].isNull(), F.lit(NO_ID))
            .when(msg[CORRUPT].isNotNull(), F.lit(PARTIAL)))


def parsed_with_reason(bronze: DataFrame, ddl: str) -> DataFrame:
    """Bronze rows plus ``msg`` and ``bad_reason``; a frame parsed already is kept as is."""
    if REASON in bronze.columns:
        return bronze
    return parse_json(bronze, ddl).withColumn(REASON, bad_reason())


def stays(settings: Settings) -> Column:
    """True for messages that become Silver rows (``partial`` ones do)."""
    return F.lit(True) if settings.keep_bad_rows else F.col(REASON).isNull() | ~F.col(REASON).isin(*DROPPED_REASONS)


def _keep(df: DataFrame, settings: Settings) -> DataFrame:
    """The rows that stay; a frame dealt to targets already (``refine_once``) is kept as is."""
    return df if TARGET in df.columns else df.filter(stays(settings))


def _processed_at(settings: Settings) -> Column:
    if settings.ingest_clock == "record":
        return F.col("bronze_ingested_at")
    return now(settings.as_of)


def _meta(table: str, settings: Settings) -> list[Column]:
    return ([F.col(c) for c in CARRIED]
            + [_processed_at(settings).alias("silver_processed_at"),
               F.lit(QUALITY_SCORE.get(table, 100)).alias("data_quality_score")]
            + [F.col(c) for c in PARTS])


def _team(i: int, field: str) -> Column:
    return F.get(F.col(f"{MSG}.participants"), i).getField(field)


def refine_fixtures(bronze: DataFrame, settings: Settings, carry: Sequence[str] = ()) -> DataFrame:
    """Silver fixtures: 13 scalars, teams by position, match date/hour, live/finished."""
    m = _keep(parsed_with_reason(bronze, FIXTURE_DDL), settings)
    flat = m.select(
        F.col(f"{MSG}.id").alias("fixture_id"),
        *[F.col(f"{MSG}.{c}").alias(c) for c in
          ("sport_id", "league_id", "season_id", "stage_id", "state_id")],
        F.col(f"{MSG}.name").alias("fixture_name"),
        *[F.col(f"{MSG}.{c}").alias(c) for c in
          ("starting_at", "result_info", "venue_id", "length", "placeholder", "has_odds")],
        _team(0, "name").alias("home_team"), _team(0, "id").alias("home_team_id"),
        _team(1, "name").alias("away_team"), _team(1, "id").alias("away_team_id"),
        *_meta("fixtures", settings), *carry,
    )
    return flat.withColumns({
        "match_date": safe_date("starting_at"),
        "match_hour": safe_hour("starting_at"),
        "is_live": is_state("state_id", STATE_LIVE),
        "is_finished": is_state("state_id", STATE_FINISHED),
    })


def _goals(i: int) -> Column:
    return F.get(F.col(f"{MSG}.scores"), i).getField("score").getField("goals")


def refine_live_scores(bronze: DataFrame, settings: Settings, carry: Sequence[str] = ()) -> DataFrame:
    """Silver live scores: scores and teams by position, event count, derived totals."""
    m = _keep(parsed_with_reason(bronze, LIVE_SCORE_DDL), settings)
    flat = m.select(
        F.col(f"{MSG}.id").alias("fixture_id"),
        *[F.col(f"{MSG}.{c}").alias(c) for c in ("sport_id", "league_id", "season_id")],
        F.col(f"{MSG}.name").alias("fixture_name"),
        F.col(f"{MSG}.starting_at").alias("starting_at"),
        F.col(f"{MSG}.state_id").alias("state_id"),
        _goals(0).alias("home_score"), _goals(1).alias("away_score"),
        _team(0, "name").alias("home_team"), _team(0, "id").alias("home_team_id"),
        _team(1, "name").alias("away_team"), _team(1, "id").alias("away_team_id"),
        F.size(F.col(f"{MSG}.events")).alias("events_count"),
        *_meta("live_scores", settings), *carry,
    )
    return flat.withColumns({
        "match_date": safe_date("starting_at"),
        "total_goals": F.try_add("home_score", "away_score"),
        "score_difference": F.try_subtract("home_score", "away_score"),
        "is_live": is_state("state_id", STATE_LIVE),
        "is_finished": is_state("state_id", STATE_FINISHED),
    })


def event_fixture_id(settings: Settings) -> Column:
    """The fixture of an event: top level, else ``_metadata``, else the key prefix."""
    top = F.col(f"{MSG}.fixture_id")
    if not settings.event_fixture_fallback:
        return top
    meta = F.try_element_at(F.col(f"{MSG}._metadata"), F.lit("fixture_id")).try_cast("bigint")
    key = F.get(F.split(F.col("kafka_key"), "_"), 0).try_cast("bigint")
    return F.coalesce(top, meta, key)


def refine_events(bronze: DataFrame, settings: Settings, carry: Sequence[str] = ()) -> DataFrame:
    """Silver events: 12 fields, event name by code, event date, minutes incl. added time."""
    m = _keep(parsed_with_reason(bronze, EVENT_DDL), settings)
    flat = m.select(
        F.col(f"{MSG}.id").alias("event_id"),
        event_fixture_id(settings).alias("fixture_id"),
        *[F.col(f"{MSG}.{c}").alias(c) for c in
          ("type_id", "section", "minute", "extra_minute", "result", "player_id",
           "player_name", "related_player_id", "related_player_name", "created_at")],
        *_meta("events", settings), *carry,
    )
    return flat.withColumns({
        "event_type": event_type("type_id"),
        "event_date": safe_date("created_at"),
        "total_minutes": F.try_add(F.col("minute"), F.coalesce(F.col("extra_minute"), F.lit(0))),
    })


def refine_leagues(bronze: DataFrame, settings: Settings, carry: Sequence[str] = ()) -> DataFrame:
    """Silver leagues (the reference stops leagues at Bronze): id and name."""
    m = _keep(parsed_with_reason(bronze, LEAGUE_DDL), settings)
    return m.select(F.col(f"{MSG}.id").alias("league_id"),
                    F.col(f"{MSG}.name").alias("league_name"), *_meta("leagues", settings), *carry)


REFINERS = {
    "fixtures": refine_fixtures,
    "livescores": refine_live_scores,
    "events": refine_events,
    "leagues": refine_leagues,
}
# Silver table name per Bronze data type.
SILVER_TABLES = {"fixtures": "fixtures", "livescores": "live_scores", "events": "events",
                 "leagues": "leagues"}

LETTER_COLUMNS = ["kafka_key", "raw_json", "kafka_topic", "data_type", "reason", "corrupt_record"]


def refine_once(bronze: DataFrame, data_type: str, settings: Settings) -> DataFrame:
    """Silver rows and dead letters of Bronze rows in one frame, from one parse.

    ``target`` says where a row goes: ``rows`` have the Silver columns, ``letters`` the message with
    the reason. A partial message goes to both, so it is dealt by a generator, which no
    filter or union can turn into a second parse.
    """
    parsed = parsed_with_reason(bronze, SCHEMAS[data_type])
    targets = F.array_compact(F.array(F.when(stays(settings), F.lit(ROWS)),
                                      F.when(F.col(REASON).isNotNull(), F.lit(LETTERS))))
    dealt = parsed.select("*", F.explode(targets).alias(TARGET))
    letter = F.col(TARGET) == LETTERS
    dealt = dealt.withColumns(
        {c: F.when(letter, F.col(c)) for c in ("raw_json", "kafka_topic", "data_type")}
        | {"reason": F.when(letter, F.col(REASON)), "corrupt_record": F.when(letter, F.col(f"{MSG}.{CORRUPT}"))})
    return REFINERS[data_type](dealt, settings, [TARGET, *LETTER_COLUMNS])
