"""Pipeline settings and the fixed values every layer shares."""

from __future__ import annotations

from dataclasses import dataclass

# Topic names per data type, as the producer and the Bronze job use them.
TOPICS = {
    "fixtures": "sports.fixtures",
    "livescores": "sports.livescores",
    "leagues": "sports.leagues",
    "events": "sports.events",
}

# Match state codes (state_id) and what they mean for the derived flags.
STATE_LIVE = 2
STATE_FINISHED = 3

# Constant data-quality score per Silver table.
QUALITY_SCORE = {"fixtures": 100, "live_scores": 95, "events": 90}

BRONZE_VERSION = "1.0"

# Partition columns of every layer table (dates of the ingest clock in Bronze and Silver,
# of the processing clock in Gold).
DATE_PARTS = ("year", "month", "day")


@dataclass(frozen=True)
class Settings:
    """Knobs of one pipeline run.

    ``as_of`` pins the clock: every "now" in the pipeline (ingest time, processing time,
    lookback cut-off, minutes elapsed) reads it instead of ``current_timestamp()`` so that
    runs are reproducible. ``None`` means the wall clock, as in production.
    """

    root: str | None = None
    table_format: str = "parquet"
    as_of: str | None = None
    # Ingest clock of Bronze: "processing" stamps current time (the reference's rule),
    # "record" stamps the broker timestamp, which keeps a backfill replay in its own days.
    ingest_clock: str = "processing"
    bronze_days_back: int | None = 7
    silver_days_back: int | None = 30
    # Season tables (team performance, standings) read the whole history by default: a
    # 30-day window would rank teams on a month of their season.
    standings_days_back: int | None = None
    # Streamed files older than this leave the sink's log (see sinks.compact); None keeps them all.
    bronze_retention: str | None = None
    silver_layer: str = "silver"          # "silver_stream": Gold on incremental Silver
    # Parity switches (each documented in README "Deviations").
    latest_snapshot: bool = True          # reduce repeated polls to the newest snapshot
    event_fixture_fallback: bool = True   # take fixture_id from _metadata / the key
    keep_bad_rows: bool = False           # keep dead-letter rows in Silver too
    team_key: str = "name"                # "name" (the reference's grouping) or "id"

    def path(self, *parts: str) -> str:
        if not self.root:
            raise ValueError("Settings.root is not set")
        return "/".join([self.root.rstrip("/"), *parts])
