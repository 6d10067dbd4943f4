"""The pipeline clock: a pinned ``as_of`` instant, or the wall clock when none is given."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def now(as_of: str | None) -> Column:
    """``current_timestamp()`` or the pinned instant (UTC)."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")


def today(as_of: str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.to_date(F.lit(as_of).cast("timestamp"))


def day_before(as_of: str | None, days: int) -> date:
    """The date ``days`` before today (UTC, or the pinned clock's day), on the driver."""
    at = datetime.fromisoformat(as_of) if as_of else datetime.now(timezone.utc)
    return at.date() - timedelta(days=days)


def day_parts(day: date) -> dict[str, int]:
    return {"year": day.year, "month": day.month, "day": day.day}


def in_days(values: dict[str, str], first: date, last: date | None = None) -> bool:
    """True if the date of partition values (year, month, day) lies in ``[first, last]``."""
    parts = [values[k] for k in ("year", "month", "day")]
    if not all(p.isdigit() for p in parts):
        return False
    day = date(*map(int, parts))
    return first <= day and (last is None or day <= last)
