"""Late messages get a table of their own instead of being dropped by a watermark.

A stateful stream drops what is older than its watermark, silently. Here the cut is made before it:
every micro-batch is split by the newest time that earlier batches have seen, less a delay.
What is older goes to the late table, the rest to the on-time table, which a stateful stream
with the same delay can read without dropping anything.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.files import children, delete, exists, publish_file, publish_folder, read_text

MARKS = "_marks"


def mark_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest time (microseconds) that batches before this one have seen."""
    known = [int(n.split(".")[0]) for n in children(spark, f"{path}/{MARKS}") if n.endswith(".json")]
    before = [b for b in known if b < batch_id]
    return json.loads(read_text(spark, f"{path}/{MARKS}/{max(before):012d}.json"))["seen"] if before else None


def split_batch(batch: DataFrame, batch_id: int, path: str, time_col: str, delay_seconds: int) -> None:
    """Write a batch's rows to ``path``/on_time and ``path``/late, and its mark.

    One pass, into folders named by the batch that are moved into place when they are
    complete: a batch that is run again, whole or from the middle, changes nothing. Rows without
    a time are on time.
    """
    spark = batch.sparkSession
    if exists(spark, f"{path}/{MARKS}/{batch_id:012d}.json"):
        return
    seen = mark_before(spark, path, batch_id)
    at = F.unix_micros(time_col)
    late = F.lit(False) if seen is None else F.coalesce(at <= seen - delay_seconds * 1_000_000, F.lit(False))
    newest = Observation(f"late:{uuid.uuid4().hex}")
    aside = f"{path}/_aside/{batch_id}-{uuid.uuid4().hex[:12]}"
    (batch.observe(newest, F.max(at).alias("seen"))
     .withColumn("went", F.when(late, F.lit("late")).otherwise(F.lit("on_time")))
     .write.partitionBy("went").parquet(aside))
    for went in ("late", "on_time"):
        if exists(spark, f"{aside}/went={went}"):
            publish_folder(spark, f"{aside}/went={went}", f"{path}/{went}/batch={batch_id}")
    delete(spark, aside)
    known = [t for t in (seen, newest.get["seen"]) if t is not None]
    publish_file(spark, f"{path}/{MARKS}/{batch_id:012d}.json", json.dumps({"seen": max(known, default=None)}))


def route_late(stream: DataFrame, path: str, checkpoint: str, time_col: str, delay_seconds: int,
               trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start the stream that splits its rows into on-time and late ones."""
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, n: split_batch(batch, n, path, time_col, delay_seconds)))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def late_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The late table; empty before the first late message."""
    if not exists(spark, f"{path}/late"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/late")
