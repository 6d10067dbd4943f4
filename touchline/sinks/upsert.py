"""A stored table of the newest row per key, merged range by range.

The table is partitioned by ranges of the key, which a row's key alone decides. A merge
reads and rewrites only the ranges that new rows fall into, and readers see it with one pointer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.snapshot import BROKER_ORDER, latest_snapshot
from touchline.sinks.snapshots import read_snapshot, snapshot
from touchline.sinks.tables import write_table

RANGE = "id_range"
RANGE_SIZE = 1 << 16  # keys of one range: the part of the table that one new row makes a merge rewrite


def id_range(key: str, size: int = RANGE_SIZE) -> Column:
    """The range of an integer key; rows without one are in range -1."""
    return F.coalesce(F.floor(F.col(key) / size).cast("bigint"), F.lit(-1).cast("bigint"))


def upsert_newest(spark: SparkSession, path: str, fresh: DataFrame, key: str,
                  order: Sequence[str] = BROKER_ORDER, size: int = RANGE_SIZE, fmt: str = "parquet",
                  tags: dict[str, object] | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge ``fresh`` rows into the table; returns its rows in the touched ranges before and after.

    Of the rows of a key the newest stays, by ``order``, wherever it comes from, so merging the same rows
    again, or older ones, changes nothing.
    """
    old = snapshot(spark, path)
    touched = {str(r[0]) for r in fresh.select(id_range(key, size)).distinct().collect()}  # reads the key only
    fresh = latest_snapshot(fresh, [key], order).withColumn(RANGE, id_range(key, size))
    inside = lambda v: v[RANGE] in touched
    before = read_snapshot(spark, old, fmt, inside) if old else spark.createDataFrame([], fresh.schema)
    columns = [c for c in fresh.columns if c != RANGE]
    # A range (at most two rows of each of its keys) meets in one task, which writes its one file; dealt by key,
    # every task would write a file of every range.
    both = before.select(*fresh.columns).unionByName(fresh).repartition(RANGE)
    merged = latest_snapshot(both, [RANGE, key], order)
    write_table(merged.select(*columns, RANGE), path, fmt, partition_by=(RANGE,), sort_by=(key,),
                owned=inside, tags=tags)
    return before.select(*columns), read_snapshot(spark, snapshot(spark, path), fmt, inside).select(*columns)
