"""Stored demo runs: land the demo records, replay them through the Bronze streams, then
run Silver and Gold into tables under the shared work root.

Each step is idempotent (landing writes once, streams resume from their checkpoints,
table writes replace partitions) and is done at most once per session and folder.
"""

from __future__ import annotations

import threading
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from touchline.config import Settings
from touchline.operators.refine import SILVER_TABLES
from touchline.operators.sketches import daily_fetches, daily_freshness
from touchline.plans import lineage as L
from touchline.plans.gold import run_gold
from touchline.plans.silver import run_silver
from touchline.plans.workspace import demo_root, land, land_late, replay_sources
from touchline.sinks.compact import compact
from touchline.sinks.tables import write_table
from touchline.streaming.bronze import run_bronze
from touchline.streaming.coverage import run_coverage
from touchline.streaming.dashboard import run_dashboard
from touchline.streaming.dedupe import run_ttl_dedup
from touchline.streaming.incremental import run_silver_streams
from touchline.streaming.monitor import run_monitors

ALL_TYPES = ("fixtures", "livescores", "leagues", "events")
_DONE: dict = {}
_LOCK = threading.RLock()  # queries may be called from several threads of one session


def store_settings(spark: SparkSession, sf_dir: str, **kw) -> Settings:
    return L.demo_settings(root=demo_root(spark, sf_dir), **kw)


def _once(step: str, spark: SparkSession, sf_dir: str, fn):
    root = demo_root(spark, sf_dir)  # names the session and the state of the input
    with _LOCK:
        for old in [k for k in _DONE if k[1] != spark.sparkContext.applicationId]:
            del _DONE[old]  # of a stopped session
        key = (step, spark.sparkContext.applicationId, root)
        if key not in _DONE:
            _DONE[key] = fn()
        return _DONE[key]


def silver_stream_store(spark: SparkSession, sf_dir: str) -> Settings:
    """Incremental Silver (and its dead letters) of all types over the stored Bronze."""
    s = bronze_store(spark, sf_dir)
    _once("silver_stream", spark, sf_dir, lambda: run_silver_streams(spark, s, SILVER_TABLES))
    return s


def ttl_store(spark: SparkSession, sf_dir: str) -> str:
    s = store_settings(spark, sf_dir)
    return _once("ttl_dedup", spark, sf_dir, lambda: run_ttl_dedup(spark, sf_dir, s))


def monitor_store(spark: SparkSession, sf_dir: str) -> str:
    """Two runs of the monitoring streams: over the landed records, then over those that arrive late."""
    s = store_settings(spark, sf_dir)

    def runs() -> str:
        for t in ALL_TYPES:
            land(spark, sf_dir, t, s.root)
        landed = f"{s.root}/{{landing,late_monitor}}/*"
        run_monitors(spark, s, landed)
        land_late(spark, sf_dir, s.root, "late_monitor")
        return run_monitors(spark, s, landed)

    return _once("monitor", spark, sf_dir, runs)


def dashboard_store(spark: SparkSession, sf_dir: str) -> Settings:
    """The live dashboard over incremental Silver."""
    s = silver_stream_store(spark, sf_dir)
    _once("dashboard", spark, sf_dir, lambda: run_dashboard(spark, s))
    return s


def coverage_store(spark: SparkSession, sf_dir: str) -> str:
    """The coverage stream over incremental Silver, and a second run after the clock has moved on."""
    s = silver_stream_store(spark, sf_dir)
    return _once("coverage", spark, sf_dir, lambda: [
        run_coverage(spark, s, heartbeat) for heartbeat in (None, "2024-03-01 00:00:00")][-1])


def compact_store(spark: SparkSession, sf_dir: str) -> Settings:
    """Compacted Bronze: the first days in one generation, the later ones in a second, the last ones not."""
    s = bronze_store(spark, sf_dir)
    _once("compact", spark, sf_dir, lambda: [
        compact(spark, s.path("bronze", t), before, s.table_format)
        for t in ALL_TYPES for before in (date(2024, 1, 10), date(2024, 1, 25))])
    return s


def sketch_store(spark: SparkSession, sf_dir: str) -> Settings:
    """Daily sketches of all Bronze messages and live-score fetches, stored by day."""
    s = store_settings(spark, sf_dir)

    def store() -> None:
        bronze = [L.bronze(spark, sf_dir, t, s) for t in ALL_TYPES]
        write_table(daily_freshness(reduce(DataFrame.unionByName, bronze)), s.path("sketches", "freshness"),
                    partition_by=("day",), owned=lambda v: True)
        write_table(daily_fetches(L.silver(spark, sf_dir, "livescores", s)), s.path("sketches", "fetches"),
                    partition_by=("fetch_date",), owned=lambda v: True)

    _once("sketches", spark, sf_dir, store)
    return s


def bronze_store(spark: SparkSession, sf_dir: str) -> Settings:
    s = store_settings(spark, sf_dir)
    _once("bronze", spark, sf_dir,
          lambda: run_bronze(spark, replay_sources(spark, sf_dir, s, ALL_TYPES), s))
    return s


def silver_store(spark: SparkSession, sf_dir: str) -> tuple[Settings, dict]:
    s = bronze_store(spark, sf_dir)
    return s, _once("silver", spark, sf_dir, lambda: run_silver(spark, s))


def gold_store(spark: SparkSession, sf_dir: str) -> tuple[Settings, dict]:
    s, _ = silver_store(spark, sf_dir)
    return s, _once("gold", spark, sf_dir, lambda: run_gold(spark, s))
