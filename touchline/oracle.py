"""Independent SQL (DuckDB dialect) for every registered query.

The oracle never parses JSON: it restates the demo generation rules of
``touchline.sources.demo`` directly over the test tables and then the intended semantics
of each operator. If the Spark pipeline (JSON out, JSON in, snapshot reduction,
aggregates) returns the same rows, the round trip and the operator are both right.
"""

from __future__ import annotations

AS_OF = "2024-02-01 00:00:00"
NOW = f"cast(epoch(timestamp '{AS_OF}') as bigint)"  # the pinned clock, in seconds

CTES = {
    "demo_matches": """
select cast(o_orderkey as bigint) as fixture_id,
       cast(1 as int) as sport_id,
       cast(o_orderkey % 5 as int) as league_id,
       cast(year(o_orderdate) as int) as season_id,
       cast(o_orderkey % 3 as int) as stage_id,
       cast(case o_orderstatus when 'F' then 3 when 'O' then 2 else 1 end as int) as state_id,
       cast(o_orderdate as timestamp) as starting_ts,
       cast(o_custkey % 20 as bigint) as home_team_id,
       cast((o_custkey % 20 + 1 + o_orderkey % 19) % 20 as bigint) as away_team_id,
       concat('Team ', cast(o_custkey % 20 as varchar)) as home_team,
       concat('Team ', cast((o_custkey % 20 + 1 + o_orderkey % 19) % 20 as varchar)) as away_team,
       cast(case when o_orderkey % 17 = 0 then null else o_custkey % 6 end as int) as home_score,
       cast(o_orderkey % 4 as int) as away_score,
       cast(case when o_orderkey % 11 = 0 then null else o_orderkey % 7 end as int) as events_count,
       cast(o_custkey % 50 as bigint) as venue_id,
       (o_orderkey % 2 = 0) as has_odds,
       timestamp '2024-01-01 00:00:00' + to_hours(cast(o_orderkey % 720 as bigint))
         - interval 1 day as fixture_ts
from orders""",
    "demo_match_events": """
select cast(event_id as bigint) as event_id,
       cast(event_id // 50 as bigint) as fixture_id,
       cast(event_id % 9 as int) as type_id,
       cast(event_id * 13 % 90 as int) as minute,
       cast(case when event_id % 4 = 0 then null else event_id % 6 end as int) as extra_minute,
       cast(user_id as bigint) as player_id,
       case when user_id % 13 = 0 then null
            else concat('Player ', cast(user_id as varchar)) end as player_name,
       cast(ts as timestamp) as created_ts
from events""",
    # of two polls of a fixture, the first names a kick-off three days later
    "fixture_polls": """
select * exclude (starting_ts, poll), poll,
       starting_ts + to_days(cast(case when n_polls - 1 > poll then 3 else 0 end as int)) as starting_ts,
       cast(fixture_id * 2 + poll as bigint) as kafka_offset,
       fixture_ts - to_hours(cast((n_polls - 1 - poll) * 6 as bigint)) as kafka_ts
from (select *, case when fixture_id % 3 = 0 then 2 else 1 end as n_polls,
             cast(unnest(generate_series(0, case when fixture_id % 3 = 0 then 1 else 0 end)) as int) as poll
      from demo_matches) p""",
    # live-score polls of started games; only the last poll carries the final state
    "poll_rows": """
select m.*, cast(m.fixture_id % 3 + 1 as int) as n_polls,
       cast(unnest(generate_series(0, m.fixture_id % 3)) as int) as poll
from demo_matches m where m.state_id in (2, 3)""",
    "live_polls": """
select fixture_id, sport_id, league_id, season_id, starting_ts, home_team_id, away_team_id,
       home_team, away_team, poll, n_polls,
       cast(case when poll = n_polls - 1 then state_id else 2 end as int) as state_id,
       cast(case when poll = n_polls - 1 then home_score else 0 end as int) as home_score,
       cast(case when poll = n_polls - 1 then away_score else 0 end as int) as away_score,
       events_count,
       cast(fixture_id * 3 + poll as bigint) as kafka_offset,
       cast(fixture_id % 3 as int) as kafka_partition,
       timestamp '2024-01-01 00:00:00' + to_hours(cast(fixture_id % 720 as bigint))
         + to_minutes(cast(poll * 30 as bigint)) as kafka_ts,
       case when poll = 0 and n_polls > 1 then
            case fixture_id % 29 when 1 then 'empty' when 2 then 'unparsable'
                                 when 3 then 'no_id' when 4 then 'partial' end end as bad_reason
from poll_rows""",
    # the newest poll per fixture (never damaged): equals the match itself
    "latest_live": """
select * from live_polls where poll = n_polls - 1""",
    "event_poll_rows": """
select e.*, cast(unnest(generate_series(0, e.event_id % 2)) as int) as poll
from demo_match_events e""",
    "event_polls": """
select p.*, cast(event_id * 2 + poll as bigint) as kafka_offset,
       cast(fixture_id % 3 as int) as kafka_partition,
       created_ts + to_minutes(cast(poll * 2 as bigint)) as kafka_ts,
       unnest(generate_series(1, case when event_id % 50 = 0 and poll = 0 then 2 else 1 end)) as copy
from event_poll_rows p""",
    "typed_events": """
select event_id, fixture_id, type_id, minute, extra_minute, player_id, player_name, created_ts,
       case type_id when 1 then 'GOAL' when 2 then 'OWN_GOAL' when 3 then 'PENALTY'
                    when 4 then 'RED_CARD' when 5 then 'YELLOW_CARD'
                    when 6 then 'SUBSTITUTION' else 'OTHER' end as event_type,
       minute + coalesce(extra_minute, 0) as total_minutes,
       case when type_id between 1 and 3
            then cast(minute % 3 as varchar) || '-' || cast(minute % 2 as varchar) end as result
from demo_match_events""",
    "results": """
select fixture_id, home_team || ' vs ' || away_team as fixture_name,
       cast(starting_ts as date) as match_date, home_team, away_team, home_score, away_score,
       home_score + away_score as total_goals, league_id, season_id,
       case when home_score > away_score then 'HOME_WIN'
            when home_score < away_score then 'AWAY_WIN' else 'DRAW' end as result,
       abs(home_score - away_score) as goal_difference
from demo_matches where state_id = 3""",
    "team_rows": """
select home_team as team, league_id, season_id,
       cast(result = 'HOME_WIN' as int) as wins, cast(result = 'DRAW' as int) as draws,
       cast(result = 'AWAY_WIN' as int) as losses,
       home_score as goals_for, away_score as goals_against, 'home' as venue
from results
union all
select away_team, league_id, season_id,
       cast(result = 'AWAY_WIN' as int), cast(result = 'DRAW' as int),
       cast(result = 'HOME_WIN' as int), away_score, home_score, 'away'
from results""",
    "team_stats": """
select team, league_id, season_id,
       cast(sum(wins) as bigint) as total_wins, cast(sum(draws) as bigint) as total_draws,
       cast(sum(losses) as bigint) as total_losses,
       cast(sum(goals_for) as bigint) as total_goals_for,
       cast(sum(goals_against) as bigint) as total_goals_against,
       count(*) as matches_played,
       cast(sum(wins) * 3 + sum(draws) as bigint) as points,
       cast(sum(goals_for) - sum(goals_against) as bigint) as goal_difference,
       cast(sum(wins) / count(*) * 100 as decimal(5,2)) as win_percentage
from team_rows group by team, league_id, season_id""",
    "standings": """
select league_id, season_id,
       cast(rank() over (partition by league_id, season_id
                         order by points desc nulls last, goal_difference desc nulls last,
                                  total_goals_for desc nulls last) as int) as position,
       team, matches_played, total_wins, total_draws, total_losses, total_goals_for,
       total_goals_against, goal_difference, points, win_percentage
from team_stats""",
}

CTES["silver_ls"] = """
select fixture_id, sport_id, league_id, season_id, home_team || ' vs ' || away_team as fixture_name,
       strftime(starting_ts, '%Y-%m-%d %H:%M:%S') as starting_at,
       case when bad_reason = 'partial' then null else state_id end as state_id,
       home_score, away_score, home_team, home_team_id, away_team, away_team_id,
       cast(events_count as int) as events_count, kafka_partition, kafka_offset,
       95 as data_quality_score,
       cast(year(kafka_ts) as int) as year, cast(month(kafka_ts) as int) as month,
       cast(day(kafka_ts) as int) as day,
       cast(floor(epoch(kafka_ts)) as bigint) as kafka_timestamp,
       cast(floor(epoch(kafka_ts)) as bigint) as bronze_ingested_at,
       cast(floor(epoch(kafka_ts)) as bigint) as silver_processed_at,
       cast(starting_ts as date) as match_date,
       home_score + away_score as total_goals, home_score - away_score as score_difference,
       coalesce(bad_reason is null and state_id = 2, false) as is_live,
       coalesce(bad_reason is null and state_id = 3, false) as is_finished
from live_polls where bad_reason is null or bad_reason = 'partial'"""
CTES["kept_polls"] = """
select *, kafka_ts as ingested_ts from live_polls
where bad_reason is null or bad_reason = 'partial'"""
# every landed broker record: data type, topic, partition, offset, broker time, fixture
CTES["all_records"] = """
select 'livescores' as data_type, 'sports.livescores' as kafka_topic, kafka_partition,
       kafka_offset, kafka_ts, fixture_id, bad_reason, cast(fixture_id as varchar) as kafka_key,
       case when coalesce(bad_reason in ('empty', 'unparsable'), false) then null
            else cast(fixture_id as varchar) end as payload_id
from live_polls
union all
select 'events', 'sports.events', kafka_partition, kafka_offset, kafka_ts, fixture_id, null,
       cast(fixture_id as varchar) || '_' || cast(event_id as varchar), cast(event_id as varchar)
from event_polls
union all
select 'fixtures', 'sports.fixtures', cast(fixture_id % 3 as int), kafka_offset,
       kafka_ts, fixture_id, null, cast(fixture_id as varchar), cast(fixture_id as varchar)
from fixture_polls
union all
select 'leagues', 'sports.leagues', cast(r_regionkey % 3 as int), cast(r_regionkey as bigint),
       timestamp '2023-12-01 00:00:00', null, null, cast(r_regionkey as varchar),
       cast(r_regionkey as varchar) from region"""

# records that land after all others (see sources.demo.late_records): new polls, and a copy of the first
CTES["late_polls"] = """
select fixture_id, cast(nth as int) as nth, cast(1000000000000 + fixture_id * 8 + nth as bigint) as kafka_offset,
       cast(fixture_id % 3 as int) as kafka_partition, cast(null as varchar) as bad_reason, poll_ts, n_polls,
       case when nth < 5 then poll_ts + to_minutes(cast([-90, -85, -60, -20, 10][nth + 1] as bigint))
            else timestamp '2024-02-02 00:00:00' + to_minutes(cast(fixture_id % 60 as bigint)) end as kafka_ts
from (select *, kafka_ts as poll_ts, unnest(generate_series(0, 5)) as nth from live_polls
      where poll = 0 and fixture_id % 41 = 7) x
union all
select fixture_id, 6, kafka_offset, kafka_partition, bad_reason, kafka_ts, n_polls, kafka_ts
from live_polls where poll = 0 and fixture_id % 41 = 7"""
# all records with how they reach a stream that has seen the landed ones first and waits a day
CTES["arrivals"] = """
select kafka_topic, kafka_partition, kafka_offset, kafka_ts, false as is_late from all_records
union all
select 'sports.livescores', kafka_partition, kafka_offset, kafka_ts,
       kafka_ts <= (select max(kafka_ts) from all_records) - interval 1 day
from late_polls"""

# Which CTEs each CTE needs (in order).
_DEPS = {
    "demo_matches": [],
    "demo_match_events": [],
    "poll_rows": ["demo_matches"],
    "live_polls": ["poll_rows"],
    "latest_live": ["live_polls"],
    "event_poll_rows": ["demo_match_events"],
    "event_polls": ["event_poll_rows"],
    "typed_events": ["demo_match_events"],
    "results": ["demo_matches"],
    "team_rows": ["results"],
    "team_stats": ["team_rows"],
    "standings": ["team_stats"],
    "silver_ls": ["live_polls"],
    "kept_polls": ["live_polls"],
    "late_polls": ["live_polls"],
    "arrivals": ["all_records", "late_polls"],
    "fixture_polls": ["demo_matches"],
    "all_records": ["live_polls", "event_polls", "fixture_polls"],
}


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} as ({CTES[n].strip()})" for n in order]
    return "with " + ",\n".join(parts) + "\n" + body.strip()
