"""Writers of the layer tables.

A batch run owns the partitions its window covers: they are replaced as a whole, so a day
that has become empty is emptied in the table too, and days outside the window stay. The rows
become visible with one pointer (``snapshots``). They are
sorted within each output partition by the given columns, which gives readers clustered
files without a global sort (a range shuffle) of the whole table.

Every run appends its row counts to a run log; readers of snapshots follow its newest entry,
which is written for empty tables as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.config import DATE_PARTS, Settings
from touchline.functions.clock import now
from touchline.sinks.snapshots import commit, new_run, table_schema, vacuum


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by the write itself (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stage(df: DataFrame, folder: str, fmt: str = "parquet", partition_by: Sequence[str] = DATE_PARTS,
          sort_by: Sequence[str] = (), max_records_per_file: int | None = None) -> None:
    """Write the rows of a run into its own folder."""
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    w = df.write.format(fmt).partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.save(folder)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = DATE_PARTS,
                sort_by: Sequence[str] = (), max_records_per_file: int | None = None,
                owned: Callable[[dict[str, str]], bool] | None = None,
                tags: dict[str, object] | None = None, keep: int = 3) -> int:
    """Write a partitioned table; returns the rows written.

    With ``owned`` (a test on partition values), the rows take the place of all partitions that it
    names. Without, only partitions with new rows are replaced. The ``keep`` newest versions stay
    readable; older ones go a day after they were written. Delta tables keep their own
    log: there, partitions with new rows are replaced.
    """
    df, obs = counted(df, f"write:{path}")
    if fmt == "delta":
        (df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).save(path))
        return int(obs.get["rows"])
    base, run = f"{path}/runs", new_run(path)
    stage(df, f"{base}/{run}", fmt, partition_by, sort_by, max_records_per_file)
    commit(df.sparkSession, path, table_schema(df, partition_by), base, run, len(partition_by), owned, tags=tags)
    vacuum(df.sparkSession, [path], base, keep)
    return int(obs.get["rows"])


RUN_LOG = "layer string, table_name string, rows bigint, run_id string"


def log_run(spark: SparkSession, settings: Settings, layer: str, report: dict[str, int]) -> None:
    """Append the row counts of a run to the layer's run log."""
    run_id = uuid.uuid4().hex
    rows = spark.createDataFrame([(layer, t, n, run_id) for t, n in report.items()], RUN_LOG)
    (rows.coalesce(1).withColumn("run_at", now(settings.as_of))
     .withColumn("logged_at", F.current_timestamp())
     .write.mode("append").parquet(settings.path(layer, "run_log")))


QUALITY_LOG = "data_type string, messages bigint, dead_letters bigint, partial bigint"


def log_quality(spark: SparkSession, settings: Settings, data_type: str, messages: int, dead_letters: int,
                partial: int) -> None:
    """Append what a Silver run has counted while it wrote: its messages, and how many of them failed."""
    row = spark.createDataFrame([(data_type, messages, dead_letters, partial)], QUALITY_LOG)
    (row.coalesce(1).withColumn("run_at", now(settings.as_of)).withColumn("logged_at", F.current_timestamp())
     .write.mode("append").parquet(settings.path("silver", "quality_log")))


def newest_quality(spark: SparkSession, settings: Settings) -> DataFrame:
    """Per data type, messages and failures of the newest Silver run, with the failure rate."""
    log = spark.read.parquet(settings.path("silver", "quality_log"))
    newest = F.max_by(F.struct("messages", "dead_letters", "partial"), F.struct("run_at", "logged_at"))
    return (log.groupBy("data_type").agg(newest.alias("n")).select("data_type", "n.*")
            .withColumn("failure_rate", F.when(F.col("messages") > 0, F.col("dead_letters") / F.col("messages"))))


def newest_runs(spark: SparkSession, settings: Settings, layer: str) -> DataFrame:
    """Per table of a layer: rows and clock of the newest run."""
    log = spark.read.parquet(settings.path(layer, "run_log"))
    newest = F.max_by(F.struct("rows", "run_at"), F.struct("run_at", "logged_at"))
    return log.groupBy("layer", "table_name").agg(newest.alias("n")).select(
        "layer", "table_name", "n.rows", "n.run_at")


def stream_append(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: Sequence[str] = DATE_PARTS, trigger: dict | None = None,
                  query_name: str | None = None, retention: str | None = None):
    """Start an append-only streaming write (exactly once via the checkpoint).

    ``retention`` (such as ``30d``) lets the sink drop older files from its log, so that the log stays
    small; ``compact`` keeps their rows for batch readers.
    """
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .partitionBy(*partition_by))
    if retention:
        w = w.option("retention", retention)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path)
