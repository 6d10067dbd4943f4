"""Registered queries: one Spark plan and one oracle SQL text per key.

Every query reads the supplied test tables (through the demo feeds) in full and runs the
real operators on them. The clock is pinned; timestamps are compared as seconds since the epoch.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import TOPICS
from touchline.operators import analytics as A
from touchline.operators import monitor as M
from touchline.operators import publish as P
from touchline.operators import quality as Q
from touchline.operators.refine import MSG, REASON, SILVER_TABLES, parsed_with_reason
from touchline.operators.sketches import fetches_over, freshness_over
from touchline.operators.snapshot import duplicate_report, latest_snapshot
from touchline.oracle import AS_OF, NOW, with_ctes
from touchline.plans import demo_runs as R
from touchline.plans import lineage as L
from touchline.plans.gold import GOLD_SORT
from touchline.plans.views import register_views
from touchline.schemas import SCHEMAS
from touchline.session import tune
from touchline.sinks.compact import read_streamed
from touchline.sinks.publish import publish, to_messages
from touchline.sinks.tables import newest_quality, newest_runs
from touchline.sources.demo import demo_records, late_records
from touchline.sources.tables import read_bronze, read_silver, read_table
from touchline.streaming.coverage import coverage, settled_polls
from touchline.streaming.dashboard import current_dashboard
from touchline.streaming.dedupe import polled_items
from touchline.streaming.monitor import corrected_counts, monitor_tables, redelivery_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SETTINGS = L.demo_settings()
ALL_TYPES = ("fixtures", "livescores", "leagues", "events")
TIMESTAMPS = ("kafka_timestamp", "bronze_ingested_at", "silver_processed_at", "processed_at",
              "last_updated")


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def seconds(df: DataFrame) -> DataFrame:
    """Clock columns as seconds since the epoch."""
    return df.withColumns({c: F.unix_seconds(c) for c in TIMESTAMPS if c in df.columns})


def of_all_types(frame: Callable[[str], DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [frame(t) for t in ALL_TYPES])


STAMPED = f"select *, {NOW} as processed_at from"


# ---------------------------------------------------------------- Gold (reference)

@register("league_standings", with_ctes(f"{STAMPED} standings", "standings"))
def q_league_standings(spark, sf_dir):
    return seconds(L.league_standings(spark, sf_dir, SETTINGS))


@register("match_results", with_ctes(f"{STAMPED} results", "results"))
def q_match_results(spark, sf_dir):
    return seconds(L.match_results(spark, sf_dir, SETTINGS))


@register("team_match_rows", with_ctes("select * from team_rows", "team_rows"))
def q_team_match_rows(spark, sf_dir):
    return A.team_match_rows(L.match_results(spark, sf_dir, SETTINGS))


@register("team_performance", with_ctes(f"{STAMPED} team_stats", "team_stats"))
def q_team_performance(spark, sf_dir):
    return seconds(L.team_performance(spark, sf_dir, SETTINGS))


@register("team_performance_by_venue", with_ctes(f"""
select {NOW} as processed_at, team, league_id, season_id, venue,
       cast(sum(wins) as bigint) as total_wins, cast(sum(draws) as bigint) as total_draws,
       cast(sum(losses) as bigint) as total_losses,
       cast(sum(goals_for) as bigint) as total_goals_for,
       cast(sum(goals_against) as bigint) as total_goals_against,
       count(*) as matches_played,
       cast(sum(wins) * 3 + sum(draws) as bigint) as points,
       cast(sum(goals_for) - sum(goals_against) as bigint) as goal_difference,
       cast(sum(wins) / count(*) * 100 as decimal(5,2)) as win_percentage
from team_rows group by team, league_id, season_id, venue""", "team_rows"))
def q_team_performance_by_venue(spark, sf_dir):
    return seconds(L.team_performance(spark, sf_dir, SETTINGS, by_venue=True))


@register("event_analytics", with_ctes(f"""
select fixture_id, event_type, cast(sum(n) as bigint) as event_count, {NOW} as processed_at,
       coalesce(string_agg(case when player_name is not null
                                then player_name || ':' || cast(n as varchar) end,
                           ',' order by player_name), '') as players,
       coalesce(string_agg(names, ',' order by player_name), '') as players_involved,
       cast(sum(case when player_name is not null then n else 0 end) as bigint) as players_named,
       count(player_name) as distinct_players,
       min(mn) as first_occurrence, max(mx) as last_occurrence
from (select fixture_id, event_type, player_name, count(*) as n,
             string_agg(player_name, ',') as names, min(total_minutes) as mn, max(total_minutes) as mx
      from typed_events group by fixture_id, event_type, player_name) p
group by fixture_id, event_type""", "typed_events"))
def q_event_analytics(spark, sf_dir):
    ev = A.event_analytics(L.gold_events(spark, sf_dir, SETTINGS), SETTINGS)
    return players_as_text(ev)


def players_as_text(df: DataFrame) -> DataFrame:
    return seconds(df.withColumns({"players": A.players_text("players"),
                                   "players_involved": F.array_join("players_involved", ",")}))


@register("goal_analytics", with_ctes(f"""
select {NOW} as processed_at, fixture_id, event_id, player_name, event_type, total_minutes, result,
       case event_type when 'OWN_GOAL' then 'OWN_GOAL' when 'PENALTY' then 'PENALTY'
                       else 'REGULAR' end as scorer_type
from typed_events where event_type in ('GOAL', 'OWN_GOAL', 'PENALTY')""", "typed_events"))
def q_goal_analytics(spark, sf_dir):
    return seconds(A.goal_analytics(L.gold_events(spark, sf_dir, SETTINGS), SETTINGS))


@register("card_analytics", with_ctes(f"""
select {NOW} as processed_at, fixture_id, event_id, player_name, event_type, total_minutes
from typed_events where event_type in ('YELLOW_CARD', 'RED_CARD')""", "typed_events"))
def q_card_analytics(spark, sf_dir):
    return seconds(A.card_analytics(L.gold_events(spark, sf_dir, SETTINGS), SETTINGS))


@register("live_dashboard", with_ctes(f"""
select fixture_id, home_team || ' vs ' || away_team as fixture_name, home_team, away_team,
       home_score, away_score, home_score + away_score as total_goals,
       cast(events_count as int) as events_count, league_id,
       strftime(starting_ts, '%Y-%m-%d %H:%M:%S') as starting_at,
       'LIVE' as match_status, '45+' as time_elapsed, cast(epoch(kafka_ts) as bigint) as last_updated,
       {NOW} as processed_at,
       cast(floor((epoch(timestamp '{AS_OF}') - epoch(starting_ts)) / 60) as bigint)
         as minutes_elapsed
from latest_live where state_id = 2""", "latest_live"))
def q_live_dashboard(spark, sf_dir):
    return seconds(A.live_dashboard(L.gold_live_scores(spark, sf_dir, SETTINGS), SETTINGS))


# ---------------------------------------------------------------- Silver (reference)

@register("silver_live_scores", with_ctes("select * from silver_ls", "silver_ls"))
def q_silver_live_scores(spark, sf_dir):
    return seconds(L.silver(spark, sf_dir, "livescores", SETTINGS))


_EVENT_COLUMNS = """
       event_id, t.fixture_id, t.type_id,
       case when t.minute < 45 then '1st-half' else '2nd-half' end as section,
       t.minute, t.extra_minute, t.result, t.player_id, t.player_name,
       cast(null as bigint) as related_player_id, cast(null as varchar) as related_player_name,
       strftime(t.created_ts, '%Y-%m-%d %H:%M:%S') as created_at"""


@register("silver_events", with_ctes(f"""
select {_EVENT_COLUMNS}, p.kafka_partition, p.kafka_offset, 90 as data_quality_score,
       cast(floor(epoch(p.kafka_ts)) as bigint) as kafka_timestamp,
       cast(floor(epoch(p.kafka_ts)) as bigint) as bronze_ingested_at,
       cast(floor(epoch(p.kafka_ts)) as bigint) as silver_processed_at,
       cast(year(p.kafka_ts) as int) as year, cast(month(p.kafka_ts) as int) as month,
       cast(day(p.kafka_ts) as int) as day, t.event_type,
       cast(t.created_ts as date) as event_date, t.total_minutes
from event_polls p join typed_events t using (event_id)""", "event_polls", "typed_events"))
def q_silver_events(spark, sf_dir):
    return seconds(L.silver(spark, sf_dir, "events", SETTINGS))


@register("silver_fixtures", with_ctes("""
select cast(epoch(kafka_ts) as bigint) as kafka_timestamp,
       cast(epoch(kafka_ts) as bigint) as bronze_ingested_at,
       cast(epoch(kafka_ts) as bigint) as silver_processed_at,
       fixture_id, sport_id, league_id, season_id, stage_id, state_id,
       home_team || ' vs ' || away_team as fixture_name,
       strftime(starting_ts, '%Y-%m-%d %H:%M:%S') as starting_at,
       case when state_id = 3 then 'Game ended' end as result_info,
       venue_id, 90 as length, false as placeholder, has_odds,
       home_team, home_team_id, away_team, away_team_id,
       cast(fixture_id % 3 as int) as kafka_partition, kafka_offset,
       100 as data_quality_score,
       cast(year(kafka_ts) as int) as year, cast(month(kafka_ts) as int) as month,
       cast(day(kafka_ts) as int) as day,
       cast(starting_ts as date) as match_date, cast(hour(starting_ts) as int) as match_hour,
       state_id = 2 as is_live, state_id = 3 as is_finished
from fixture_polls""", "fixture_polls"))
def q_silver_fixtures(spark, sf_dir):
    return seconds(L.silver(spark, sf_dir, "fixtures", SETTINGS))


# ---------------------------------------------------------------- Bronze (reference)

def payload_id():
    return F.get_json_object(F.col("raw_json"), "$.id").alias("payload_id")


_RECORD = """data_type, kafka_key, kafka_topic, kafka_partition, kafka_offset, payload_id,
       '1.0' as bronze_version, cast(floor(epoch(kafka_ts)) as bigint) as kafka_timestamp,
       cast(floor(epoch(kafka_ts)) as bigint) as bronze_ingested_at"""
_DAY = """cast(year(kafka_ts) as int) as year, cast(month(kafka_ts) as int) as month,
       cast(day(kafka_ts) as int) as day"""


def record_columns(bronze: DataFrame, *more: str) -> DataFrame:
    return seconds(bronze.select("data_type", "kafka_key", "kafka_topic", "kafka_partition",
                                 "kafka_offset", "bronze_version", "kafka_timestamp",
                                 "bronze_ingested_at", payload_id(), *more))


@register("bronze_decode", with_ctes(f"select {_RECORD} from all_records", "all_records"))
def q_bronze_decode(spark, sf_dir):
    return record_columns(of_all_types(lambda t: L.bronze(spark, sf_dir, t, SETTINGS)))


@register("bronze_replay", with_ctes(f"select {_RECORD}, {_DAY} from all_records", "all_records"))
def q_bronze_replay(spark, sf_dir):
    s = R.bronze_store(spark, sf_dir)
    return record_columns(of_all_types(lambda t: read_table(spark, s.path("bronze", t), s.table_format)),
                          "year", "month", "day")


@register("bronze_all_types", with_ctes("""
select data_type, cast(year(kafka_ts) as int) as year, count(*) as messages,
       count(distinct kafka_offset) as distinct_offsets
from all_records group by data_type, year(kafka_ts)""", "all_records"))
def q_bronze_all_types(spark, sf_dir):
    s = R.bronze_store(spark, sf_dir)
    union = of_all_types(lambda t: read_table(spark, s.path("bronze", t), s.table_format))
    return union.groupBy("data_type", "year").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("kafka_offset").alias("distinct_offsets"))


@register("date_parts", with_ctes(f"select data_type, kafka_partition, kafka_offset, {_DAY} from all_records",
                                   "all_records"))
def q_date_parts(spark, sf_dir):
    return of_all_types(lambda t: L.bronze(spark, sf_dir, t, SETTINGS)).select(
        "data_type", "kafka_partition", "kafka_offset", "year", "month", "day")


@register("bronze_compacted", with_ctes(f"select {_RECORD}, {_DAY} from all_records", "all_records"))
def q_bronze_compacted(spark, sf_dir):
    s = R.compact_store(spark, sf_dir)
    return record_columns(of_all_types(lambda t: read_streamed(spark, s.path("bronze", t), s.table_format)),
                          "year", "month", "day")


@register("bronze_lookback", with_ctes(f"""
select {_RECORD}, {_DAY} from all_records
where kafka_ts >= date '2024-02-01' - interval 7 day""", "all_records"))
def q_bronze_lookback(spark, sf_dir):
    s = R.bronze_store(spark, sf_dir)
    return record_columns(of_all_types(lambda t: read_bronze(spark, s.path("bronze", t), s, days_back=7)),
                          "year", "month", "day")


_SINCE = "kafka_ts >= date '2024-02-01' - interval 10 day"


@register("silver_lookback", with_ctes(f"""
select 'live_scores' as table_name, fixture_id, kafka_partition, kafka_offset from live_polls
where (bad_reason is null or bad_reason = 'partial') and {_SINCE}
union all select 'fixtures', fixture_id, cast(fixture_id % 3 as int), kafka_offset from fixture_polls where {_SINCE}
union all select 'events', fixture_id, kafka_partition, kafka_offset from event_polls where {_SINCE}""",
                                       "live_polls", "fixture_polls", "event_polls"))
def q_silver_lookback(spark, sf_dir):
    s, _ = R.silver_store(spark, sf_dir)
    return functools.reduce(DataFrame.unionByName, [
        read_silver(spark, s.path("silver", t), s, days_back=10)
        .select(F.lit(t).alias("table_name"), "fixture_id", "kafka_partition", "kafka_offset")
        for t in ("live_scores", "fixtures", "events")])


@register("silver_write_roundtrip", with_ctes("select * from silver_ls", "silver_ls"))
def q_silver_write_roundtrip(spark, sf_dir):
    s, _ = R.silver_store(spark, sf_dir)
    return seconds(read_table(spark, s.path("silver", "live_scores"), s.table_format))


def _silver_stored(table: str):
    @register(f"silver_stored_{table}", ORACLES[f"silver_{table}"])
    def query(spark, sf_dir):
        s, _ = R.silver_store(spark, sf_dir)
        return seconds(read_table(spark, s.path("silver", table), s.table_format))


for _t in ("fixtures", "events"):
    _silver_stored(_t)


@register("gold_write_roundtrip", with_ctes(f"""
select *, cast(year(date '2024-02-01') as int) as year, cast(2 as int) as month, cast(1 as int) as day,
       {NOW} as processed_at from standings""", "standings"))
def q_gold_write_roundtrip(spark, sf_dir):
    s, _ = R.gold_store(spark, sf_dir)
    return seconds(read_table(spark, s.path("gold", "league_standings"), s.table_format))


def _gold_stored(table: str):
    """Every stored Gold table, read through its SQL view."""
    @register(f"gold_stored_{table}", ORACLES[table])
    def query(spark, sf_dir):
        s, _ = R.gold_store(spark, sf_dir)
        register_views(spark, s, (table,))
        df = spark.table(table).drop("year", "month", "day")
        return players_as_text(df) if table == "event_analytics" else seconds(df)


for _t in GOLD_SORT:
    _gold_stored(_t)


@register("run_metrics", with_ctes("""
select 'silver' as layer, 'fixtures' as table_name, count(*) as rows from fixture_polls
union all select 'silver', 'live_scores', count(*) from silver_ls
union all select 'silver', 'events', count(*) from event_polls
union all select 'silver', 'leagues', count(*) from region
union all select 'silver', 'dead_letters_fixtures', 0
union all select 'silver', 'dead_letters_live_scores', count(*) from live_polls
          where bad_reason is not null
union all select 'silver', 'dead_letters_events', 0
union all select 'silver', 'dead_letters_leagues', 0
union all select 'gold', 'match_results', count(*) from results
union all select 'gold', 'team_performance', count(*) from team_stats
union all select 'gold', 'league_standings', count(*) from team_stats
union all select 'gold', 'live_dashboard', count(*) from demo_matches where state_id = 2
union all select 'gold', 'event_analytics', count(*)
          from (select distinct fixture_id, event_type from typed_events) x
union all select 'gold', 'goal_analytics', count(*) from typed_events
          where event_type in ('GOAL', 'OWN_GOAL', 'PENALTY')
union all select 'gold', 'card_analytics', count(*) from typed_events
          where event_type in ('YELLOW_CARD', 'RED_CARD')""",
          "fixture_polls", "silver_ls", "event_polls", "results", "team_stats", "typed_events"))
def q_run_metrics(spark, sf_dir):
    s, _ = R.gold_store(spark, sf_dir)
    return (newest_runs(spark, s, "silver").union(newest_runs(spark, s, "gold"))
            .select("layer", "table_name", "rows"))


# ---------------------------------------------------------------- Silver pieces (reference)

@register("parse_json", with_ctes("""
select 'livescores' as data_type, kafka_partition, kafka_offset,
       case when bad_reason in ('empty', 'unparsable', 'no_id') then null else fixture_id end as id,
       case when bad_reason is null or bad_reason = 'no_id' then state_id end as state_id,
       case when bad_reason in ('empty', 'unparsable') then null
            else home_team || ' vs ' || away_team end as name,
       bad_reason
from live_polls
union all
select 'fixtures', cast(fixture_id % 3 as int), kafka_offset, fixture_id, state_id,
       home_team || ' vs ' || away_team, null
from fixture_polls
union all select 'events', kafka_partition, kafka_offset, event_id, null, null, null from event_polls
union all
select 'leagues', cast(r_regionkey % 3 as int), cast(r_regionkey as bigint), cast(r_regionkey as bigint), null,
       'League ' || r_name, null
from region""", "live_polls", "fixture_polls", "event_polls"))
def q_parse_json(spark, sf_dir):
    def rows(t: str) -> DataFrame:
        parsed = parsed_with_reason(L.bronze(spark, sf_dir, t, SETTINGS), SCHEMAS[t])
        known = parsed.schema[MSG].dataType.names
        def field(name, kind):
            return (F.col(f"{MSG}.{name}") if name in known else F.lit(None).cast(kind)).alias(name)
        return parsed.select("data_type", "kafka_partition", "kafka_offset", field("id", "bigint"),
                             field("state_id", "int"), field("name", "string"), F.col(REASON).alias("bad_reason"))
    return of_all_types(rows)


@register("event_type_map", with_ctes("""
select event_id, type_id, event_type from typed_events""", "typed_events"))
def q_event_type_map(spark, sf_dir):
    return L.gold_events(spark, sf_dir, SETTINGS).select("event_id", "type_id", "event_type")


# ---------------------------------------------------------------- poller steps, re-aimed

def newest_fixtures(spark, sf_dir):
    return L.current(L.silver(spark, sf_dir, "fixtures", SETTINGS), "fixtures", SETTINGS)


@register("publish_envelope", with_ctes("""
select cast(fixture_id as varchar) as key, 'sports.fixtures' as topic, 'demo' as source,
       '2024-02-01T00:00:00' as fetched_at, 'fixture' as envelope_type, 'v3' as api_version,
       home_team || ' vs ' || away_team as name
from demo_matches""", "demo_matches"))
def q_publish_envelope(spark, sf_dir):
    s = R.store_settings(spark, sf_dir)
    objects = newest_fixtures(spark, sf_dir).select(
        F.col("fixture_id").alias("id"), F.col("fixture_name").alias("name"), "league_id",
        "season_id", "state_id", "starting_at")
    msgs = to_messages(P.with_envelope(objects, "fixture", s), TOPICS["fixtures"])
    out = s.path("published", uuid.uuid4().hex[:12])  # never a folder that a frame still reads
    publish(msgs, fmt="parquet", path=out)
    back = read_table(spark, out, "parquet")
    return back.select("key", "topic",
                       F.get_json_object("value", "$._metadata.source").alias("source"),
                       F.get_json_object("value", "$._metadata.fetched_at").alias("fetched_at"),
                       F.get_json_object("value", "$._metadata.type").alias("envelope_type"),
                       F.get_json_object("value", "$._metadata.api_version").alias("api_version"),
                       F.get_json_object("value", "$.name").alias("name"))


PAGE_SIZE = 100


@register("explode_page", with_ctes(f"""
select cast(fixture_id // {PAGE_SIZE} as bigint) as page_no,
       cast(row_number() over (partition by fixture_id // {PAGE_SIZE} order by fixture_id) - 1
            as int) as item_position,
       fixture_id, home_team || ' vs ' || away_team as name
from demo_matches""", "demo_matches"))
def q_explode_page(spark, sf_dir):
    m = newest_fixtures(spark, sf_dir)
    item = F.to_json(F.struct(F.col("fixture_id").alias("id"), F.col("fixture_name").alias("name")))
    # Pages of at most PAGE_SIZE objects (bounded groups), objects ordered by id.
    pages = (m.select((F.col("fixture_id") / PAGE_SIZE).cast("bigint").alias("page_no"),
                      F.struct("fixture_id", item.alias("j")).alias("it"))
             .groupBy("page_no").agg(F.array_sort(F.collect_list("it")).alias("items"))
             .select("page_no", F.concat(F.lit('{"data":['),
                                         F.array_join(F.transform("items", lambda x: x["j"]), ","),
                                         F.lit("]}")).alias("page")))
    # An error page without ``data`` yields no rows.
    errors = spark.range(1).select(F.lit(-1).cast("bigint").alias("page_no"),
                                   F.lit('{"message":"quota exceeded"}').alias("page"))
    items = P.explode_page(pages.unionByName(errors))
    return items.select("page_no", "item_position",
                        F.get_json_object("item_json", "$.id").cast("bigint").alias("fixture_id"),
                        F.get_json_object("item_json", "$.name").alias("name"))


@register("event_fanout", with_ctes("""
select cast(fixture_id as varchar) || '_' || cast(fixture_id * 10 + i as varchar) as key,
       fixture_id, kafka_offset, cast(i - 1 as int) as event_position,
       fixture_id * 10 + i as event_id, cast(i % 9 as int) as type_id,
       '{"id":"' || cast(fixture_id * 10 + i as varchar) || '","type_id":"' || cast(i % 9 as varchar)
         || '","minute":"' || cast(i * 11 % 90 as varchar)
         || '","_metadata":{"source":"demo","type":"event","fixture_id":' || cast(fixture_id as varchar)
         || ',"fetched_at":"2024-02-01T00:00:00","api_version":"v3"}}' as value
from (select *, unnest(generate_series(1, events_count)) as i from kept_polls
      where events_count > 0) x""", "kept_polls"))
def q_event_fanout(spark, sf_dir):
    ev = P.event_fanout(L.bronze(spark, sf_dir, "livescores", SETTINGS), SETTINGS)
    return ev.select("key", "fixture_id", "kafka_offset", "event_position", "event_id", "type_id",
                     "value")


UPCOMING_AS_OF = "1998-03-15 00:00:00"


@register("upcoming_fixtures", with_ctes(f"""
select fixture_id, strftime(starting_ts, '%Y-%m-%d %H:%M:%S') as starting_at, home_team, away_team
from demo_matches
where starting_ts between timestamp '{UPCOMING_AS_OF}'
                      and timestamp '{UPCOMING_AS_OF}' + interval 24 hour""", "demo_matches"))
def q_upcoming_fixtures(spark, sf_dir):
    s = L.demo_settings(as_of=UPCOMING_AS_OF)
    fx = L.silver(spark, sf_dir, "fixtures", SETTINGS)
    return P.upcoming_fixtures(fx, s).select("fixture_id", "starting_at", "home_team",
                                             "away_team")


_LATE = "fixture_id % 41 = 7"
_UNREAD = "coalesce(bad_reason in ('empty', 'unparsable'), false)"


@register("ttl_dedup", with_ctes(f"""
select 'events' as data_type, event_id as item_id, cast(floor(epoch(min(kafka_ts))) as bigint) as kept_at
from event_polls group by event_id
union all select 'fixtures', fixture_id, cast(epoch(kafka_ts) as bigint) from fixture_polls
union all select 'leagues', cast(r_regionkey as bigint), cast(epoch(timestamp '2023-12-01') as bigint)
from region
union all
-- polls lie exactly 30 minutes apart, so none repeats another; those that cannot be read have no id
select 'livescores', case when {_UNREAD} then null else fixture_id end, cast(epoch(kafka_ts) as bigint)
from live_polls
union all
-- of the late ones, 90 and 60 minutes before the first poll are far from all that is kept; 20 minutes
-- before it is too if that poll could not be read, and 10 minutes after it never is
select 'livescores', case when {_UNREAD} then null else fixture_id end, cast(epoch(kafka_ts) as bigint)
from late_polls
where nth in (0, 2, 5) or (nth = 3 and n_polls > 1 and fixture_id % 29 in (1, 2)) or (nth = 6 and {_UNREAD})""",
                                "event_polls", "fixture_polls", "live_polls", "late_polls"))
def q_ttl_dedup(spark, sf_dir):
    path = R.ttl_store(spark, sf_dir)
    return of_all_types(lambda t: read_table(spark, f"{path}/{t}", "parquet")).select(
        "data_type", "item_id", F.unix_seconds("kafka_timestamp").alias("kept_at"))


@register("ttl_dedup_history", with_ctes(f"""
-- in time order, a poll 20 minutes before the first one is kept, hides it, and lets one 10 minutes after it
-- stand, which hides the second
select 'livescores' as data_type, case when {_UNREAD} then null else fixture_id end as item_id,
       cast(epoch(kafka_ts) as bigint) as kept_at
from live_polls where {_UNREAD} or not {_LATE} or poll = 2
union all
select 'livescores', case when {_UNREAD} then null else fixture_id end, cast(epoch(kafka_ts) as bigint)
from late_polls where nth in (0, 2, 3, 4, 5) or (nth = 6 and {_UNREAD})
union all select 'events', event_id, cast(floor(epoch(min(kafka_ts))) as bigint)
from event_polls group by event_id
union all select 'fixtures', fixture_id, cast(epoch(kafka_ts) as bigint) from fixture_polls
union all select 'leagues', cast(r_regionkey as bigint), cast(epoch(timestamp '2023-12-01') as bigint)
from region""", "event_polls", "fixture_polls", "live_polls", "late_polls"))
def q_ttl_dedup_history(spark, sf_dir):
    items = of_all_types(lambda t: polled_items(demo_records(spark, sf_dir, t), t))
    items = items.unionByName(polled_items(late_records(spark, sf_dir), "livescores"))
    return P.skip_repeats(items, ["data_type", "item_id"]).select(
        "data_type", "item_id", F.unix_seconds("kafka_timestamp").alias("kept_at"))


@register("stream_redeliveries", with_ctes("""
select kafka_topic, count(*) as messages,
       count(distinct case when not is_late then kafka_partition || '-' || kafka_offset end) as kept,
       count(distinct kafka_partition || '-' || kafka_offset)
         - count(distinct case when not is_late then kafka_partition || '-' || kafka_offset end) as late,
       count(*) - count(distinct kafka_partition || '-' || kafka_offset) as repeats
from arrivals group by kafka_topic""", "arrivals"))
def q_stream_redeliveries(spark, sf_dir):
    out = R.monitor_store(spark, sf_dir)
    kept, _, late = monitor_tables(spark, out)
    on_time = spark.read.schema(kept.schema).parquet(f"{out}/on_time")
    return redelivery_report(kept, late, on_time.unionByName(late))


@register("stream_throughput", with_ctes("""
select kafka_topic, cast(epoch(date_trunc('hour', kafka_ts)) as bigint) as window_start_epoch,
       count(*) as messages, cast(sum(case when is_late then 1 else 0 end) as bigint) as late
from arrivals
where date_trunc('hour', kafka_ts) + interval 1 hour <= (select max(kafka_ts) from arrivals) - interval 1 day
group by kafka_topic, date_trunc('hour', kafka_ts)""", "arrivals"))
def q_stream_throughput(spark, sf_dir):
    _, closed, late = monitor_tables(spark, R.monitor_store(spark, sf_dir))
    return corrected_counts(closed, late)


@register("stream_dashboard", ORACLES["live_dashboard"])
def q_stream_dashboard(spark, sf_dir):
    return seconds(current_dashboard(spark, R.dashboard_store(spark, sf_dir)))


@register("fetch_summary", with_ctes("""
select cast(kafka_ts as date) as fetch_date, count(*) as messages,
       count(distinct fixture_id) as games, cast(sum(events_count) as bigint) as events
from kept_polls group by cast(kafka_ts as date)""", "kept_polls"))
def q_fetch_summary(spark, sf_dir):
    return P.fetch_summary(L.silver(spark, sf_dir, "livescores", SETTINGS))


# ---------------------------------------------------------------- named in the docs only

_DEAD_LETTERS = with_ctes("""
select kafka_key, kafka_topic, kafka_partition, kafka_offset, data_type, bad_reason as reason,
       cast(epoch(kafka_ts) as bigint) as kafka_timestamp,
       cast(epoch(kafka_ts) as bigint) as bronze_ingested_at,
       case bad_reason when 'empty' then '' when 'unparsable' then 'not json: ' || kafka_key end as text
from all_records where bad_reason is not null""", "all_records")


def letter_columns(df: DataFrame) -> DataFrame:
    text = F.when(F.col("reason").isin("empty", "unparsable"), F.col("raw_json"))
    return seconds(df.select("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "data_type",
                             "reason", "kafka_timestamp", "bronze_ingested_at", text.alias("text")))


@register("dead_letters", _DEAD_LETTERS)
def q_dead_letters(spark, sf_dir):
    return letter_columns(of_all_types(
        lambda t: Q.dead_letters(L.bronze(spark, sf_dir, t, SETTINGS), t, SETTINGS)))


@register("dead_letters_stored", _DEAD_LETTERS)
def q_dead_letters_stored(spark, sf_dir):
    s, _ = R.silver_store(spark, sf_dir)
    return letter_columns(read_table(spark, s.path("silver", "dead_letters"), s.table_format))


@register("dead_letters_incremental", _DEAD_LETTERS)
def q_dead_letters_incremental(spark, sf_dir):
    s = R.silver_stream_store(spark, sf_dir)
    schema = Q.dead_letters(L.bronze(spark, sf_dir, "leagues", s), "leagues", s).schema
    return letter_columns(of_all_types(lambda t: read_table(
        spark, s.path("silver_stream", f"dead_letters_{SILVER_TABLES[t]}"), s.table_format, schema)))


@register("failure_rate", with_ctes("""
select data_type, count(*) as messages,
       cast(sum(case when bad_reason in ('empty', 'unparsable', 'no_id') then 1 else 0 end) as bigint) as dead_letters,
       cast(sum(case when bad_reason = 'partial' then 1 else 0 end) as bigint) as partial,
       cast(sum(case when bad_reason in ('empty', 'unparsable', 'no_id') then 1 else 0 end) as bigint) / count(*) as failure_rate
from all_records group by data_type""", "all_records"))
def q_failure_rate(spark, sf_dir):
    return of_all_types(lambda t: Q.failure_rate(L.bronze(spark, sf_dir, t, SETTINGS), t))


@register("failure_rate_stored", ORACLES["failure_rate"])
def q_failure_rate_stored(spark, sf_dir):
    """The failure rate that the Silver run has counted while it wrote, without parsing again."""
    s, _ = R.silver_store(spark, sf_dir)
    return newest_quality(spark, s)


@register("latest_snapshot", with_ctes("""
select fixture_id, state_id, home_score, away_score, kafka_offset from latest_live""",
                                       "latest_live"))
def q_latest_snapshot(spark, sf_dir):
    sl = L.silver(spark, sf_dir, "livescores", SETTINGS).select(
        "fixture_id", "state_id", "home_score", "away_score", "kafka_timestamp",
        "kafka_partition", "kafka_offset")
    return latest_snapshot(sl, ["fixture_id"]).drop("kafka_timestamp", "kafka_partition")


@register("duplicate_report", with_ctes("""
select kafka_topic, kafka_partition, kafka_offset, count(*) as copies
from all_records group by all having count(*) > 1""", "all_records"))
def q_duplicate_report(spark, sf_dir):
    return duplicate_report(of_all_types(lambda t: L.bronze(spark, sf_dir, t, SETTINGS)))


@register("offset_gaps", with_ctes("""
select kafka_topic, kafka_partition, min(kafka_offset) as first_offset, max(kafka_offset) as last_offset,
       count(distinct kafka_offset) as offsets_seen,
       max(kafka_offset) - min(kafka_offset) + 1 - count(distinct kafka_offset) as offsets_missing
from all_records group by kafka_topic, kafka_partition""", "all_records"))
def q_offset_gaps(spark, sf_dir):
    return M.offset_gaps(of_all_types(lambda t: L.bronze(spark, sf_dir, t, SETTINGS)))


_PROFILED = ["fixture_id", "sport_id", "league_id", "season_id", "fixture_name", "starting_at",
             "state_id", "home_score", "away_score", "home_team", "home_team_id", "away_team",
             "away_team_id", "events_count", "match_date", "total_goals", "score_difference"]


@register("null_profile", with_ctes("\nunion all\n".join(
    f"select '{c}' as column_name, count(*) as rows, count(*) - count({c}) as null_count, "
    f"(count(*) - count({c})) / count(*) as null_share from silver_ls" for c in _PROFILED),
    "silver_ls"))
def q_null_profile(spark, sf_dir):
    return Q.null_profile(L.silver(spark, sf_dir, "livescores", SETTINGS), _PROFILED)


@register("timestamp_checks", with_ctes("""
select data_type, count(*) as messages,
       cast(sum(case when bad_reason in ('empty', 'unparsable') then 1 else 0 end) as bigint) as missing_fetched_at,
       cast(sum(case when coalesce(bad_reason not in ('empty', 'unparsable'), true)
                          and fixture_id % 31 = 0
                          and data_type in ('livescores', 'events', 'fixtures')
                     then 1 else 0 end) as bigint) as fetched_after_broker,
       cast(0 as bigint) as broker_after_ingest
from all_records group by data_type""", "all_records"))
def q_timestamp_checks(spark, sf_dir):
    union = of_all_types(lambda t: L.bronze(spark, sf_dir, t, SETTINGS))
    return Q.timestamp_checks(union)


@register("quality_flags", with_ctes("""
select fixture_id, kafka_partition, kafka_offset,
       concat_ws(',',
         case when is_finished and (home_score is null or away_score is null)
              then 'NULL_SCORE_ON_FINISHED' end,
         case when home_team is null or away_team is null then 'MISSING_TEAM' end,
         case when starting_at is not null and match_date is null then 'BAD_DATE' end,
         case when state_id is null then 'MISSING_STATE' end) as flags
from silver_ls
where (is_finished and (home_score is null or away_score is null))
   or home_team is null or away_team is null
   or (starting_at is not null and match_date is null) or state_id is null""", "silver_ls"))
def q_quality_flags(spark, sf_dir):
    f = Q.quality_flags(L.silver(spark, sf_dir, "livescores", SETTINGS))
    return f.withColumn("flags", F.array_join("flags", ","))


@register("freshness", with_ctes(f"""
select data_type, count(*) as messages,
       cast(floor(epoch(max(kafka_ts))) as bigint) as last_message_epoch,
       cast(epoch(timestamp '{AS_OF}') as bigint) - cast(floor(epoch(max(kafka_ts))) as bigint)
         as seconds_since_last,
       min(latency) as min_latency_s, max(latency) as max_latency_s,
       avg(latency) as avg_latency_s, quantile_disc(latency, 0.5) as latency_p50_s,
       quantile_disc(latency, 0.95) as latency_p95_s
from (select *, case when bad_reason in ('empty', 'unparsable') then null
                     when data_type = 'leagues' then cast(0 as bigint)
                     when fixture_id % 31 = 0 then cast(-7 as bigint)
                     else cast(2 as bigint) end as latency
      from all_records) r
group by data_type""", "all_records"))
def q_freshness(spark, sf_dir):
    union = of_all_types(lambda t: L.bronze(spark, sf_dir, t, SETTINGS))
    return M.freshness(union, SETTINGS)


@register("throughput", with_ctes("""
select kafka_topic, cast(epoch(date_trunc('hour', kafka_ts)) as bigint) as window_start_epoch,
       count(*) as messages
from all_records group by kafka_topic, date_trunc('hour', kafka_ts)""", "all_records"))
def q_throughput(spark, sf_dir):
    union = of_all_types(lambda t: L.bronze(spark, sf_dir, t, SETTINGS))
    return M.throughput(union)


@register("match_coverage", with_ctes("""
select league_id, season_id, count(*) as fixtures,
       cast(sum(case when state_id in (2, 3) then 1 else 0 end) as bigint) as covered,
       cast(sum(case when state_id in (2, 3) then 1 else 0 end) as bigint) / count(*) as coverage
from demo_matches group by league_id, season_id""", "demo_matches"))
def q_match_coverage(spark, sf_dir):
    fx = L.silver(spark, sf_dir, "fixtures", SETTINGS)
    lv = L.silver(spark, sf_dir, "livescores", SETTINGS)
    return M.match_coverage(fx, lv, SETTINGS)


def _silver_incremental(key: str, table: str):
    @register(key, ORACLES[f"silver_{table}"])
    def query(spark, sf_dir):
        s = R.silver_stream_store(spark, sf_dir)
        return seconds(read_table(spark, s.path("silver_stream", table), s.table_format))


_silver_incremental("silver_incremental", "live_scores")
for _t in ("fixtures", "events"):
    _silver_incremental(f"silver_incremental_{_t}", _t)


@register("stream_coverage", ORACLES["match_coverage"])
def q_stream_coverage(spark, sf_dir):
    return coverage(settled_polls(spark, R.coverage_store(spark, sf_dir)), SETTINGS)


@register("freshness_history", with_ctes("""
select data_type, count(*) as messages, cast(floor(epoch(max(kafka_ts))) as bigint) as last_message_epoch,
       quantile_disc(latency, 0.5) as latency_p50_s, quantile_disc(latency, 0.95) as latency_p95_s
from (select *, case when bad_reason in ('empty', 'unparsable') then null
                     when data_type = 'leagues' then cast(0 as bigint)
                     when fixture_id % 31 = 0 then cast(-7 as bigint) else cast(2 as bigint) end as latency
      from all_records where kafka_ts < timestamp '2024-01-25') r
group by data_type""", "all_records"))
def q_freshness_history(spark, sf_dir):
    s = R.sketch_store(spark, sf_dir)
    return freshness_over(read_table(spark, s.path("sketches", "freshness")), last="2024-01-24")


@register("fetch_history", with_ctes("""
select cast(date_trunc('week', kafka_ts) as date) as period, count(*) as messages,
       cast(sum(events_count) as bigint) as events, count(distinct fixture_id) as games, true as close
from kept_polls group by date_trunc('week', kafka_ts)""", "kept_polls"))
def q_fetch_history(spark, sf_dir):
    """Weeks out of daily sketches, beside the exact number of games: close means within 5 %."""
    s = R.sketch_store(spark, sf_dir)
    week = F.date_trunc("week", "kafka_timestamp").cast("date").alias("period")
    exact = (L.silver(spark, sf_dir, "livescores", SETTINGS).groupBy(week)
             .agg(F.count_distinct("fixture_id").alias("exact")))
    about = fetches_over(read_table(spark, s.path("sketches", "fetches")))
    return about.join(exact, "period").select(
        "period", "messages", "events", F.col("exact").alias("games"),
        (F.abs(F.col("games") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close"))


@register("sql_views", with_ctes("""
select league_id, season_id, team, points, goal_difference, matches_played
from standings where position = 1""", "standings"))
def q_sql_views(spark, sf_dir):
    s, _ = R.gold_store(spark, sf_dir)
    register_views(spark, s, ("league_standings",))
    return spark.sql("""
        select league_id, season_id, team, points, goal_difference, matches_played
        from league_standings where position = 1""")


@register("standings_named", with_ctes(f"""
select s.*, {NOW} as processed_at, 'League ' || r.r_name as league_name
from standings s left join region r on s.league_id = r.r_regionkey""", "standings"))
def q_standings_named(spark, sf_dir):
    st = L.league_standings(spark, sf_dir, SETTINGS, ordered=False)
    named = A.standings_named(st, L.leagues(spark, sf_dir, SETTINGS))
    return seconds(named)
