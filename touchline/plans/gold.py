"""The Gold run: Silver (lookback) -> newest snapshots -> seven analytic tables.

The snapshot-reduced live scores are computed once and kept while the four tables that
depend on them are written; the same holds for events. The reference re-reads and
re-derives its input for every table and counts rows in extra jobs; here each table is
one write job and its row count rides on that job (``Observation``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from touchline.config import Settings
from touchline.session import tune
from touchline.functions.clock import day_before, in_days
from touchline.functions.dates import with_date_parts
from touchline.operators import analytics as A
from touchline.operators.snapshot import SNAPSHOT_KEYS, latest_snapshot
from touchline.plans.season import performance, refresh, state_path
from touchline.sinks.snapshots import snapshot
from touchline.sinks.tables import log_run, write_table
from touchline.sources.tables import lookback, read_table

LIVE_COLUMNS = ["fixture_id", "fixture_name", "match_date", "home_team", "away_team",
                "home_team_id", "away_team_id",
                "home_score", "away_score", "total_goals", "events_count", "league_id",
                "season_id", "starting_at", "silver_processed_at", "is_live", "is_finished",
                "kafka_timestamp", "kafka_partition", "kafka_offset"]
EVENT_COLUMNS = ["fixture_id", "event_id", "type_id", "event_type", "player_name",
                 "total_minutes", "result", "kafka_timestamp", "kafka_partition", "kafka_offset"]

GOLD_SORT = {
    "match_results": ("league_id", "season_id"),
    "team_performance": ("league_id", "season_id", "team"),
    "league_standings": ("league_id", "season_id", "position"),
    "event_analytics": ("fixture_id",),
    "goal_analytics": ("fixture_id",),
    "card_analytics": ("fixture_id",),
    "live_dashboard": ("league_id",),
}


def current_input(spark: SparkSession, settings: Settings, table: str,
                  columns: list[str], days_back: int | None) -> DataFrame:
    """A Silver table over ``days_back`` days of processing time (None = all history),
    pruned to ``columns`` and reduced to the newest snapshot per key."""
    df = read_table(spark, settings.path(settings.silver_layer, table), settings.table_format)
    df = lookback(df, "silver_processed_at", days_back, settings.as_of).select(*columns)
    if settings.latest_snapshot:
        df = latest_snapshot(df, SNAPSHOT_KEYS[table])
    return df


def recent(df: DataFrame, settings: Settings) -> DataFrame:
    """The part of a (season-wide) input processed within ``silver_days_back``."""
    return lookback(df, "silver_processed_at", settings.silver_days_back, settings.as_of)


def gold_frames(live: DataFrame, events: DataFrame, settings: Settings,
                perf: DataFrame | None = None) -> dict[str, DataFrame]:
    """``live`` covers the season window; tables of the recent window filter it. ``perf`` are team totals
    that are known already."""
    live_recent = recent(live, settings)
    results = A.match_results(live_recent, settings)
    if perf is None:
        perf = A.team_performance(A.team_match_rows(A.match_results(live, settings)), settings)
    return {
        "match_results": results,
        "team_performance": perf,
        "league_standings": A.league_standings(perf, ordered=False),
        "live_dashboard": A.live_dashboard(live_recent, settings),
        "event_analytics": A.event_analytics(events, settings),
        "goal_analytics": A.goal_analytics(events, settings),
        "card_analytics": A.card_analytics(events, settings),
    }


def run_gold(spark: SparkSession, settings: Settings, rebuild: bool = False) -> dict[str, int]:
    """Build and write every Gold table; returns rows written per table.

    Season tables over all history come from stored state that follows the changed Silver days
    (``season``); ``rebuild`` builds that state anew. Over streamed Silver, the newest row per fixture is that of
    the dashboard's stream, which reads new files only. A window of days, parity without snapshot reduction,
    and Delta tables are read as a whole.
    """
    tune(spark)
    kept_up = settings.standings_days_back is None and settings.latest_snapshot and settings.table_format != "delta"
    perf = None
    if kept_up and settings.silver_layer == "silver_stream":
        from touchline.streaming.dashboard import newest_live, run_dashboard  # it builds on this module

        run_dashboard(spark, settings)
        live = newest_live(spark, settings)
    elif kept_up and snapshot(spark, settings.path(settings.silver_layer, "live_scores")) is not None:
        live = refresh(spark, settings, LIVE_COLUMNS, rebuild)
        if settings.team_key == "name":
            perf = performance(read_table(spark, state_path(settings, "team_sums"), settings.table_format), settings)
    else:
        # One read of live scores over the season window (standings_days_back; None = all);
        # the recent window of the other tables is a filter on it (silver_processed_at).
        live = current_input(spark, settings, "live_scores", LIVE_COLUMNS,
                             settings.standings_days_back).persist(StorageLevel.MEMORY_AND_DISK)
    events = current_input(spark, settings, "events", EVENT_COLUMNS,
                           settings.silver_days_back).persist(StorageLevel.MEMORY_AND_DISK)
    report: dict[str, int] = {}
    today = day_before(settings.as_of, 0)  # the run owns the snapshot of its processing day
    try:
        for name, df in gold_frames(live, events, settings, perf).items():
            report[name] = write_table(with_date_parts(df, "processed_at"),
                                       settings.path("gold", name), settings.table_format,
                                       sort_by=GOLD_SORT[name],
                                       owned=lambda v: in_days(v, today, today))
    finally:
        live.unpersist()
        events.unpersist()
    log_run(spark, settings, "gold", report)
    return report
