"""Gold: match results, team tables, standings, event summaries, live dashboard.

Scale notes. Every aggregate here is algebraic (sum, count, min, max) and so combines
map-side before its shuffle: a team, league or fixture holding a third of all rows
sends one partial row per map task. The standings window runs after the team
aggregate, on one row per team; its largest group is one league season. The event
summary never gathers a group's raw rows: players are first counted per
(fixture, kind, player), so a group's player list is bounded by the distinct players in
it, not by its events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.config import Settings
from touchline.functions.clock import now
from touchline.functions.codes import (
    AWAY_WIN, CARD_KINDS, DRAW, GOAL_KINDS, HOME_WIN, match_result, scorer_type,
)


def match_results(live_scores: DataFrame, settings: Settings) -> DataFrame:
    """Finished matches with their result and absolute goal difference.

    With ``settings.team_key == "id"`` the team ids are carried as well.
    """
    ids = ["home_team_id", "away_team_id"] if settings.team_key == "id" else []
    return (live_scores.filter(F.col("is_finished"))
            .select("fixture_id", "fixture_name", "match_date", "home_team", "away_team",
                    "home_score", "away_score", "total_goals", "league_id", "season_id", *ids)
            .withColumns({
                "result": match_result("home_score", "away_score"),
                "goal_difference": F.abs(F.try_subtract("home_score", "away_score")),
                "processed_at": now(settings.as_of),
            }))


def _side(team: str, gf: str, ga: str, win: str, loss: str, venue: str,
          team_id: str | None = None) -> Column:
    r = F.col("result")
    ident = [F.col(team_id).alias("team_id")] if team_id else []
    return F.struct(
        *ident, F.col(team).alias("team"), F.col("league_id"), F.col("season_id"),
        (r == win).cast("int").alias("wins"),
        (r == DRAW).cast("int").alias("draws"),
        (r == loss).cast("int").alias("losses"),
        F.col(gf).alias("goals_for"), F.col(ga).alias("goals_against"),
        F.lit(venue).alias("venue"),
    )


def team_match_rows(results: DataFrame) -> DataFrame:
    """One row per team per match (home and away), from ONE scan of the results.

    ``inline(array(home, away))`` is a Generate over a single scan; a ``union`` of two
    projections would read the input twice.
    """
    by_id = "home_team_id" in results.columns
    home = _side("home_team", "home_score", "away_score", HOME_WIN, AWAY_WIN, "home",
                 "home_team_id" if by_id else None)
    away = _side("away_team", "away_score", "home_score", AWAY_WIN, HOME_WIN, "away",
                 "away_team_id" if by_id else None)
    return results.select(F.inline(F.array(home, away)))


def team_performance(rows: DataFrame, settings: Settings, by_venue: bool = False) -> DataFrame:
    """Totals per team, league and season (and venue when ``by_venue``).

    Teams are keyed by name, as in the reference (two teams of one name merge), or by id
    when the rows carry ``team_id``; the name is then the largest one seen for the id.
    """
    by_id = "team_id" in rows.columns
    team = ["team_id"] if by_id else ["team"]
    keys = [*team, "league_id", "season_id", *(["venue"] if by_venue else [])]
    names = [F.max("team").alias("team")] if by_id else []
    stats = rows.groupBy(*keys).agg(
        *names,
        F.sum("wins").alias("total_wins"),
        F.sum("draws").alias("total_draws"),
        F.sum("losses").alias("total_losses"),
        F.sum("goals_for").alias("total_goals_for"),
        F.sum("goals_against").alias("total_goals_against"),
        F.count(F.lit(1)).alias("matches_played"),
        (F.sum("wins") * 3 + F.sum("draws")).alias("points"),
    )
    return with_team_figures(stats, settings)


def with_team_figures(stats: DataFrame, settings: Settings) -> DataFrame:
    """Team totals with what follows from them."""
    return stats.withColumns({
        "goal_difference": F.col("total_goals_for") - F.col("total_goals_against"),
        "win_percentage": (F.col("total_wins") / F.col("matches_played") * 100)
        .cast("decimal(5,2)"),
        "processed_at": now(settings.as_of),
    })


STANDINGS_COLUMNS = ["league_id", "season_id", "position", "team", "matches_played",
                     "total_wins", "total_draws", "total_losses", "total_goals_for",
                     "total_goals_against", "goal_difference", "points", "win_percentage",
                     "processed_at"]


def league_standings(performance: DataFrame, ordered: bool = True) -> DataFrame:
    """Rank teams per league season by points, goal difference, goals for (ties share)."""
    w = Window.partitionBy("league_id", "season_id").orderBy(
        F.col("points").desc_nulls_last(), F.col("goal_difference").desc_nulls_last(),
        F.col("total_goals_for").desc_nulls_last())
    cols = list(STANDINGS_COLUMNS)
    if "team_id" in performance.columns:
        cols.insert(cols.index("team"), "team_id")
    out = performance.withColumn("position", F.rank().over(w)).select(*cols)
    return out.orderBy("league_id", "season_id", "position") if ordered else out


def event_players(events: DataFrame) -> DataFrame:
    """Long form of who was involved: occurrences per (fixture, kind, player)."""
    return (events.filter(F.col("player_name").isNotNull())
            .groupBy("fixture_id", "event_type", "player_name")
            .agg(F.count(F.lit(1)).alias("occurrences")))


def event_analytics(events: DataFrame, settings: Settings) -> DataFrame:
    """Per fixture and event kind: count, players involved, first and last minute.

    ``players_involved`` lists the named players (NULL names dropped), a name once per
    event, sorted by name; ``players`` has the same as ``(player_name, occurrences)``. Both are
    built from per-player counts, so no raw rows are gathered.
    """
    per_player = events.groupBy("fixture_id", "event_type", "player_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("total_minutes").alias("first_m"),
        F.max("total_minutes").alias("last_m"))
    named = F.col("player_name").isNotNull()
    entry = F.struct(F.col("player_name"), F.col("n").alias("occurrences"))
    out = per_player.groupBy("fixture_id", "event_type").agg(
        F.sum("n").alias("event_count"),
        F.collect_list(F.when(named, entry)).alias("players"),
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("players_named"),
        F.count_if(named).alias("distinct_players"),
        F.min("first_m").alias("first_occurrence"),
        F.max("last_m").alias("last_occurrence"))
    return out.select(
        "fixture_id", "event_type", "event_count",
        F.flatten(F.transform(F.array_sort("players"), lambda p: F.array_repeat(
            p["player_name"], p["occurrences"].cast("int")))).alias("players_involved"),
        F.array_sort("players").alias("players"), "players_named", "distinct_players", "first_occurrence", "last_occurrence",
        now(settings.as_of).alias("processed_at"))


def players_text(players: str | Column = "players") -> Column:
    """Render ``players`` as ``name:count,name:count`` (sorted by name)."""
    c = F.col(players) if isinstance(players, str) else players
    return F.array_join(F.transform(c, lambda e: F.concat(
        e["player_name"], F.lit(":"), e["occurrences"].cast("string"))), ",")


def goal_analytics(events: DataFrame, settings: Settings) -> DataFrame:
    """Goal events with the kind of scorer (OWN_GOAL / PENALTY / REGULAR)."""
    return (events.filter(F.col("event_type").isin(*GOAL_KINDS))
            .select("fixture_id", "event_id", "player_name", "event_type", "total_minutes",
                    "result")
            .withColumn("scorer_type", scorer_type("event_type"))
            .withColumn("processed_at", now(settings.as_of)))


def card_analytics(events: DataFrame, settings: Settings) -> DataFrame:
    """Card events: fixture, player, kind, minute."""
    return (events.filter(F.col("event_type").isin(*CARD_KINDS))
            .select("fixture_id", "event_id", "player_name", "event_type", "total_minutes")
            .withColumn("processed_at", now(settings.as_of)))


def minutes_since(start_text: str | Column, settings: Settings) -> Column:
    """Whole minutes from kick-off to the pipeline clock (NULL for bad start text)."""
    c = F.col(start_text) if isinstance(start_text, str) else start_text
    start = F.try_to_timestamp(c)
    return F.floor((F.unix_seconds(now(settings.as_of)) - F.unix_seconds(start)) / 60)


def live_dashboard(live_scores: DataFrame, settings: Settings) -> DataFrame:
    """Live matches for the dashboard, with minutes elapsed since kick-off."""
    return (live_scores.filter(F.col("is_live"))
            .select("fixture_id", "fixture_name", "home_team", "away_team", "home_score",
                    "away_score", "total_goals", "events_count", "league_id", "starting_at",
                    F.col("silver_processed_at").alias("last_updated"))
            .withColumns({
                "match_status": F.lit("LIVE"),
                "time_elapsed": F.lit("45+"),
                "minutes_elapsed": minutes_since("starting_at", settings),
                "processed_at": now(settings.as_of),
            }))


def standings_named(standings: DataFrame, leagues: DataFrame) -> DataFrame:
    """Standings with the league name (left join: a league without a name stays).

    No hint: adaptive execution broadcasts the leagues if their measured size allows it.
    """
    return standings.join(leagues.select("league_id", "league_name"), on="league_id", how="left")
