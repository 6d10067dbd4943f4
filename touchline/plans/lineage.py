"""Lazy Bronze -> Silver -> Gold lineage over the demo feeds of a test-data folder.

Nothing here runs a job; each function returns the plan that a Gold table would have if
the layers were stored, with the JSON parse, snapshot reduction and aggregates in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.config import Settings
from touchline.operators import analytics as A
from touchline.operators.ingest import to_bronze
from touchline.operators.refine import REFINERS, SILVER_TABLES
from touchline.operators.snapshot import SNAPSHOT_KEYS, latest_snapshot
from touchline.sources.demo import demo_records

# The pinned clock of the demo runs: the day after the 30-day broker replay ends.
DEMO_AS_OF = "2024-02-01 00:00:00"


def demo_settings(**kw) -> Settings:
    base = dict(as_of=DEMO_AS_OF, ingest_clock="record", bronze_days_back=None,
                silver_days_back=None)
    base.update(kw)
    return Settings(**base)


def bronze(spark: SparkSession, sf_dir: str, data_type: str, settings: Settings) -> DataFrame:
    return to_bronze(demo_records(spark, sf_dir, data_type), data_type, settings)


def silver(spark: SparkSession, sf_dir: str, data_type: str, settings: Settings) -> DataFrame:
    return REFINERS[data_type](bronze(spark, sf_dir, data_type, settings), settings)


def current(silver_df: DataFrame, table: str, settings: Settings,
            columns: list[str] | None = None) -> DataFrame:
    """Silver as Gold reads it: the newest snapshot per key (unless parity is asked).

    ``columns`` prunes first: the snapshot struct would otherwise carry (and shuffle)
    every Silver column, since Catalyst cannot prune inside it.
    """
    if columns:
        silver_df = silver_df.select(*columns)
    if not settings.latest_snapshot or table not in SNAPSHOT_KEYS:
        return silver_df
    return latest_snapshot(silver_df, SNAPSHOT_KEYS[table])


def gold_live_scores(spark, sf_dir, settings) -> DataFrame:
    from touchline.plans.gold import LIVE_COLUMNS
    return current(silver(spark, sf_dir, "livescores", settings), "live_scores", settings, LIVE_COLUMNS)


def gold_events(spark, sf_dir, settings) -> DataFrame:
    from touchline.plans.gold import EVENT_COLUMNS
    return current(silver(spark, sf_dir, "events", settings), "events", settings, EVENT_COLUMNS)


def match_results(spark, sf_dir, settings) -> DataFrame:
    return A.match_results(gold_live_scores(spark, sf_dir, settings), settings)


def team_performance(spark, sf_dir, settings, by_venue=False) -> DataFrame:
    rows = A.team_match_rows(match_results(spark, sf_dir, settings))
    return A.team_performance(rows, settings, by_venue=by_venue)


def league_standings(spark, sf_dir, settings, ordered=True) -> DataFrame:
    return A.league_standings(team_performance(spark, sf_dir, settings), ordered=ordered)


def leagues(spark, sf_dir, settings) -> DataFrame:
    lg = silver(spark, sf_dir, "leagues", settings)
    lg = latest_snapshot(lg, ["league_id"])
    return lg.withColumn("league_id", lg["league_id"].cast("int"))


__all__ = ["DEMO_AS_OF", "demo_settings", "bronze", "silver", "current", "SILVER_TABLES"]
