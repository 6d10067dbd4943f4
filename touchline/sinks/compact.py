"""Upkeep of a streamed table: its many small files rewritten into few, each message read once.

A streaming sink lists its files in a log, which stream readers follow, so files are never rewritten in
place. A compaction writes the rows of closed days into a table of snapshots beside it; the pointer of
a version also names the streamed files that the version covers. Batch readers take that version and the
streamed files it does not cover. Stream readers go on following the log, where each
message stands once. With a retention the sink drops old files from its log; those that are covered and no
longer listed are deleted.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import DATE_PARTS
from touchline.files import delete, exists, size_of
from touchline.functions.clock import in_days
from touchline.operators.snapshot import BROKER_ORDER
from touchline.sinks.snapshots import read_snapshot, snapshot
from touchline.sinks.tables import write_table

COVERED = "covered"
# Stored bytes that one task sorts and writes; message texts take some thirty times as much in its memory.
FILE_BYTES = 32 << 20


def compact_path(path: str) -> str:
    return f"{path}-compact"


def listed_files(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """The files of a streamed table, as its sink's log lists them, below ``path``."""
    if not exists(spark, path):
        return []
    depth = len(DATE_PARTS) + 1
    return sorted("/".join(f.split("/")[-depth:]) for f in spark.read.format(fmt).load(path).inputFiles())


def day_of(file: str) -> dict[str, str]:
    """Partition values of a file below the table."""
    return dict(p.split("=", 1) for p in file.split("/")[:-1])


def files_of(spark: SparkSession, path: str, files: Iterable[str], like: DataFrame, fmt: str = "parquet") -> DataFrame:
    files = list(files)
    if not files:
        return like.limit(0)
    return (spark.read.schema(like.schema).option("basePath", path).format(fmt)
            .load([f"{path}/{f}" for f in files]).select(*like.columns))


def read_streamed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A streamed table for batch readers: its compacted version and the files that this does not cover."""
    snap = snapshot(spark, compact_path(path)) if fmt != "delta" else None
    if snap is None:
        return spark.read.format(fmt).load(path)
    compacted = read_snapshot(spark, snap, fmt)
    covered = set(snap.tags[COVERED])
    rest = [f for f in listed_files(spark, path, fmt) if f not in covered]
    return compacted.unionByName(files_of(spark, path, rest, compacted, fmt))


def compact(spark: SparkSession, path: str, before: date, fmt: str = "parquet",
            file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Compact the streamed files of days before ``before``; returns the files read, written and deleted.

    A day's rows go to files of about ``file_bytes``, ordered by broker time; late files of a day that is
    compacted already make it be written again, with them.
    """
    out = compact_path(path)
    snap = snapshot(spark, out)
    listed, covered = listed_files(spark, path, fmt), set(snap.tags[COVERED]) if snap else set()
    fresh = [f for f in listed if f not in covered and in_days(day_of(f), date.min)
             and not in_days(day_of(f), before)]
    gone = sorted(covered.difference(listed))
    if fresh:
        days = [day_of(f) for f in fresh]
        touched = lambda v: v in days
        rows = files_of(spark, path, fresh, spark.read.format(fmt).load(path).limit(0), fmt)
        if snap:
            rows = rows.unionByName(read_snapshot(spark, snap, fmt, touched))
            again = sum(size_of(spark, f"{snap.base}/{f}") for f, v in snap.parts.items() if touched(v))
        else:
            again = 0
        total = again + sum(size_of(spark, f"{path}/{f}") for f in fresh)
        # Ranges of the order, not one task a day: a hot day is shared out, and a range ends few files.
        order = [*DATE_PARTS, *BROKER_ORDER]
        rows = rows.repartitionByRange(max(1, -(-total // file_bytes)), *order)
        write_table(rows, out, fmt, sort_by=BROKER_ORDER, owned=touched,
                    tags={COVERED: sorted((covered | set(fresh)) - set(gone))})
    for f in gone:  # the log no longer lists them, and the compacted table holds their rows
        delete(spark, f"{path}/{f}")
    after = snapshot(spark, out)
    return {"read": len(fresh), "deleted": len(gone),
            "files": len(read_snapshot(spark, after, fmt).inputFiles()) if after else 0}


def files_per_day(df: DataFrame) -> dict[str, int]:
    """Files that a read of each day opens."""
    found = (df.select(F.concat_ws("-", *DATE_PARTS).alias("day"), F.input_file_name().alias("file")).distinct()
             .groupBy("day").count().collect())
    return {r["day"]: r["count"] for r in found}
