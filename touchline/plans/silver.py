"""Silver run: one pass per data type over the Bronze window gives Silver rows and dead letters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.config import DATE_PARTS, Settings
from touchline.functions.clock import day_before, in_days
from touchline.operators.quality import dead_letters
from touchline.operators.refine import (
    LETTER_COLUMNS, LETTERS, PARTIAL, REFINERS, ROWS, SILVER_TABLES, TARGET, refine_once,
)
from touchline.session import tune
from touchline.sinks.snapshots import commit, new_run, table_schema, vacuum
from touchline.sinks.tables import log_quality, log_run, stage, write_table
from touchline.sources.tables import read_bronze

SILVER_ORDER = ("fixtures", "livescores", "events", "leagues")


def run_silver(spark: SparkSession, settings: Settings,
               types=SILVER_ORDER) -> dict[str, int]:
    """Refine each data type and write it; returns rows written per table.

    Each message is parsed once: one write deals Silver rows and dead letters to folders of their
    own, and both tables then point to theirs. The run
    owns the days of the window in every table. Errors are raised, never turned into an empty success.
    """
    tune(spark)
    days = settings.bronze_days_back
    first = date.min if days is None else day_before(settings.as_of, days)
    report: dict[str, int] = {}
    for dt in types:
        bronze = read_bronze(spark, settings.path("bronze", dt), settings)
        write = _write_delta if settings.table_format == "delta" else _write_once
        report |= write(spark, bronze, dt, settings, first)
    if settings.table_format != "delta":
        tables = [settings.path("silver", t) for t in [*SILVER_TABLES.values(), "dead_letters"]]
        vacuum(spark, tables, settings.path("silver", "runs"), keep=2 * len(SILVER_ORDER))
    log_run(spark, settings, "silver", report)
    return report


def _write_once(spark: SparkSession, bronze: DataFrame, data_type: str, settings: Settings,
                first: date) -> dict[str, int]:
    table, base = SILVER_TABLES[data_type], settings.path("silver", "runs")
    both, counts = refine_once(bronze, data_type, settings), Observation(f"silver:{data_type}")
    partial = (F.col(TARGET) == LETTERS) & (F.col("reason") == PARTIAL)
    observed = both.observe(counts, *[F.count_if(F.col(TARGET) == t).alias(t) for t in (ROWS, LETTERS)],
                            F.count_if(partial).alias(PARTIAL))
    run = new_run(base)
    stage(observed, f"{base}/{run}", settings.table_format, [TARGET, *DATE_PARTS])
    rows = table_schema(both.drop(TARGET, *LETTER_COLUMNS), DATE_PARTS)
    letters = table_schema(dead_letters(bronze, data_type, settings), DATE_PARTS)
    commit(spark, settings.path("silver", table), rows, base, f"{run}/{TARGET}={ROWS}", 3,
           owned=lambda v: in_days(v, first))
    commit(spark, settings.path("silver", "dead_letters"), letters, base, f"{run}/{TARGET}={LETTERS}", 3,
           owned=lambda v: v["data_type"] == data_type and in_days(v, first), extra={"data_type": data_type})
    rows, letters, partial = (int(counts.get[c]) for c in (ROWS, LETTERS, PARTIAL))
    # A partial message is a row and a letter; others that fail are letters only (or rows too, if kept).
    dropped = letters - partial
    log_quality(spark, settings, data_type, rows + (0 if settings.keep_bad_rows else dropped), dropped, partial)
    return {table: rows, f"dead_letters_{table}": letters}


def _write_delta(spark: SparkSession, bronze: DataFrame, data_type: str, settings: Settings,
                 first: date) -> dict[str, int]:
    """Delta tables have a log of their own, so that each is written by itself."""
    table = SILVER_TABLES[data_type]
    return {table: write_table(REFINERS[data_type](bronze, settings), settings.path("silver", table), "delta"),
            f"dead_letters_{table}": write_table(
                dead_letters(bronze, data_type, settings), settings.path("silver", "dead_letters"), "delta",
                partition_by=("data_type", *DATE_PARTS))}
