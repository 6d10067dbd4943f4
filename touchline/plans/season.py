"""Season tables kept up to date: what a Gold run needs of the whole history, without reading it again.

Two stored tables hold it: the newest live score per fixture, and sums per team, league and season. A run
reads the Silver days that have changed since the last run, merges their rows into the
first, and corrects the sums by what the touched fixtures counted before and count now. A day that
has vanished from Silver, or other settings, make it build both from all days again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import Settings
from touchline.operators import analytics as A
from touchline.sinks.snapshots import Snapshot, read_snapshot, snapshot
from touchline.sinks.tables import write_table
from touchline.sinks.upsert import upsert_newest
from touchline.sources.tables import read_table

TEAM = ["team", "league_id", "season_id"]
MEASURES = ["wins", "draws", "losses", "goals_for", "goals_against"]


def state_path(settings: Settings, table: str) -> str:
    return settings.path("gold_state", table)


def changed_days(silver: Snapshot, state: Snapshot | None) -> list[dict[str, str]] | None:
    """Partition values of the Silver folders that the state has not seen; None: all must be read."""
    if state is None:
        return None
    seen = state.tags.get("silver", {})
    now = {str(v) for v in silver.parts.values()}
    if any(str(v) not in now for v in seen.values()):
        return None
    return [v for f, v in silver.parts.items() if f not in seen]


def fresh_rows(spark: SparkSession, settings: Settings, columns: list[str],
               rebuild: bool = False) -> tuple[Snapshot, DataFrame | None, bool]:
    """(Silver version, its rows in changed days or None without any, whether these are all days)."""
    silver = snapshot(spark, settings.path(settings.silver_layer, "live_scores"))
    days = None if rebuild else changed_days(silver, snapshot(spark, state_path(settings, "newest_live")))
    if days is not None and not days:
        return silver, None, False
    rows = read_snapshot(spark, silver, settings.table_format, None if days is None else lambda v: v in days)
    return silver, rows.select(*columns), days is None


def contributions(live: DataFrame, settings: Settings, sign: int) -> DataFrame:
    """What fixtures add to the sums (or, with sign -1, take back): per measure its sum and its number
    of known values, since a sum without any is null."""
    rows = A.team_match_rows(A.match_results(live, settings))
    return rows.select(*TEAM, F.lit(sign).cast("bigint").alias("matches"), *[c for m in MEASURES for c in (
        (F.coalesce(F.col(m), F.lit(0)) * sign).cast("bigint").alias(f"sum_{m}"),
        (F.col(m).isNotNull().cast("int") * sign).cast("bigint").alias(f"n_{m}"))])


def summed(rows: DataFrame) -> DataFrame:
    """Sums per team, league and season; teams without a match left out."""
    values = [c for c in rows.columns if c not in TEAM]
    return rows.groupBy(*TEAM).agg(*[F.sum(c).alias(c) for c in values]).where("matches > 0")


def performance(sums: DataFrame, settings: Settings) -> DataFrame:
    """``team_performance`` out of the stored sums."""
    known = {m: F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}")) for m in MEASURES}
    return A.with_team_figures(sums.select(
        *TEAM, *[known[m].alias(f"total_{m}") for m in MEASURES], F.col("matches").alias("matches_played"),
        (known["wins"] * 3 + known["draws"]).alias("points")), settings)


def refresh(spark: SparkSession, settings: Settings, columns: list[str], rebuild: bool = False) -> DataFrame:
    """Bring both tables up to date; returns the newest live score per fixture."""
    live, sums = (state_path(settings, t) for t in ("newest_live", "team_sums"))
    fmt = settings.table_format
    silver, fresh, whole = fresh_rows(spark, settings, columns, rebuild)
    before = snapshot(spark, live)
    settled = snapshot(spark, sums)
    # The sums belong to one version of the fixtures: a run that died between the two commits leaves others.
    follows = bool(before and settled and settled.tags.get("live") == before.version)
    if fresh is None and follows:
        return read_snapshot(spark, before, fmt).select(*columns)
    if fresh is not None:
        if whole and before:
            _forget(spark, live, before, fmt)
        old, new = upsert_newest(spark, live, fresh, "fixture_id", fmt=fmt, tags={"silver": silver.parts})
    version = snapshot(spark, live).version
    if whole or not follows:
        rows = contributions(read_table(spark, live, fmt), settings, 1)
    else:
        touched = fresh.select(F.col("fixture_id").alias("touched")).distinct()
        same = F.col("fixture_id").eqNullSafe(F.col("touched"))
        rows = (read_snapshot(spark, settled, fmt)
                .unionByName(contributions(old.join(touched, same, "left_semi"), settings, -1))
                .unionByName(contributions(new.join(touched, same, "left_semi"), settings, 1)))
    write_table(summed(rows), sums, fmt, partition_by=(), owned=lambda v: True, tags={"live": version})
    return read_table(spark, live, fmt).select(*columns)


def _forget(spark: SparkSession, path: str, old: Snapshot, fmt: str) -> None:
    """An empty version, so that a rebuild merges with nothing."""
    empty = spark.createDataFrame([], old.schema)
    write_table(empty, path, fmt, partition_by=old.schema.names[-1:], owned=lambda v: True)
