"""Date helpers: partition parts and tolerant parsing of foreign date text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.config import DATE_PARTS


def with_date_parts(df: DataFrame, ts: str | Column) -> DataFrame:
    """Add ``year``, ``month``, ``day`` (int) of a timestamp: the layer partition keys."""
    c = F.col(ts) if isinstance(ts, str) else ts
    y, m, d = DATE_PARTS
    return df.withColumns({y: F.year(c), m: F.month(c), d: F.dayofmonth(c)})


def safe_timestamp(text: str | Column) -> Column:
    """Text to timestamp; NULL (not an error) for text that is no date."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c)


def safe_date(text: str | Column) -> Column:
    """Text to date (``yyyy-MM-dd`` with optional time part); NULL for bad text."""
    return F.to_date(safe_timestamp(text))


def safe_hour(text: str | Column) -> Column:
    return F.hour(safe_timestamp(text))
