"""Re-deliveries dropped: each message once, by topic, partition and offset.

Two forms. In a stream, Spark's own operator: it shuffles whole messages and holds every key of a batch in its state,
which suits small batches. Stored (``start_kept``), for batches of any size: only keys are shuffled, with the place of
each row in its file, and sorted on disk if they must be; the rows that repeat come out as bits, and whole
messages are then copied file by file without them. There is no state beside the kept messages themselves.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from touchline.files import children, delete, exists, publish_file, publish_folder
from touchline.session import release
from touchline.streaming.late import MARKS, mark_before

MESSAGE = ["kafka_topic", "kafka_partition", "kafka_offset"]
DELAY_SECONDS = 24 * 3600
ROW_BITS = 40         # a place is a file's number and, in these bits, the row in it
WORD_BITS = 6         # the repeats among 64 rows in a row are the bits of one number
KEYS_PER_TASK = 1 << 20
WORDS_PER_COPY = 1 << 18  # numbers that a copying job's tasks hold at once


def nth_copy(messages: DataFrame, order: str) -> DataFrame:
    """Messages with ``nth``: 1 for the first copy of a message by ``order``, 2 for the next one, ..."""
    return messages.withColumn("nth", F.row_number().over(Window.partitionBy(*MESSAGE[::-1]).orderBy(order)))


def without_redeliveries(messages: DataFrame, delay_seconds: int = DELAY_SECONDS) -> DataFrame:
    """A stream of messages, each offset once. Copies carry their message's broker time, so an on-time copy
    always meets the state of the first."""
    return (messages.withWatermark("kafka_timestamp", f"{delay_seconds} seconds")
            .dropDuplicatesWithinWatermark(MESSAGE))


def kept_lately(spark: SparkSession, path: str, batch_id: int, schema: StructType, since: int | None) -> DataFrame:
    """Messages of the batches before this one that are newer than ``since`` (microseconds)."""
    known = [n for n in children(spark, path) if n.startswith("batch=") and int(n.split("=")[1]) < batch_id]
    if not known or since is None:
        return spark.createDataFrame([], schema)
    kept = spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in known])
    return kept.where(F.col("kafka_timestamp") > F.timestamp_micros(F.lit(since)))


def write_repeats(batch: DataFrame, numbers: DataFrame, earlier: DataFrame, tasks: int, path: str) -> None:
    """Write which rows of a batch repeat another row of it or an earlier message: (block of 64 rows, bits)."""
    place = (F.shiftleft("number", ROW_BITS) + F.col("row")).alias("place")
    rows = batch.join(F.broadcast(numbers), "file").select(*MESSAGE, place)
    first = earlier.select(*MESSAGE, F.lit(-1).cast("bigint").alias("place"))  # before all rows of the batch
    copies = nth_copy(rows.unionByName(first).repartition(tasks, *MESSAGE), "place").where("nth > 1 and place >= 0")
    bits = F.bit_or(F.expr(f"shiftleft(1L, cast(place & {(1 << WORD_BITS) - 1} as int))"))
    copies.groupBy(F.shiftright("place", WORD_BITS).alias("block")).agg(bits.alias("bits")).write.parquet(path)


def runs_of_files(words: dict[int, int], files: int, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of file numbers with at most ``most`` words of repeats each, or one file."""
    start = held = 0
    for number in range(files):
        if number > start and held + words.get(number, 0) > most:
            yield start, number
            start = number
            held = 0
        held += words.get(number, 0)
    if files:
        yield start, files


def keep_batch(batch: DataFrame, batch_id: int, path: str, schema: StructType, delay_seconds: int,
               words_per_copy: int = WORDS_PER_COPY) -> None:
    """Write the whole messages of a batch (``located``) to ``path``, each once, and its mark.

    A message repeats one of an earlier batch if that is not older than the watermark by more than
    the delay, as in a stream. The folder is moved into place when it is complete.
    """
    spark = batch.sparkSession
    if exists(spark, f"{path}/{MARKS}/{batch_id:012d}.json"):
        return
    seen, delay = mark_before(spark, path, batch_id), delay_seconds * 1_000_000
    files = (batch.groupBy("file").agg(F.count(F.lit(1)).alias("rows"),
                                       F.max(F.unix_micros("kafka_timestamp")).alias("seen")).orderBy("file").collect())
    aside = f"{path}/_aside/{batch_id}-{uuid.uuid4().hex[:12]}"
    total = sum(f["rows"] for f in files)
    if files:
        numbers = spark.createDataFrame([(f["file"], i) for i, f in enumerate(files)], "file string, number bigint")
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // KEYS_PER_TASK))
        write_repeats(batch, numbers, kept_lately(spark, path, batch_id, schema, None if seen is None else seen - 2 * delay),
                      tasks, f"{aside}/repeats")
        if total > KEYS_PER_TASK:  # the keys' shuffle goes before the messages are copied, once Python has let go of it
            time.sleep(2)
            release(spark)
        repeats = spark.read.schema("block bigint, bits bigint").parquet(f"{aside}/repeats")
        number = F.shiftright("block", ROW_BITS - WORD_BITS)
        found = {r["number"]: r for r in repeats.groupBy(number.alias("number")).agg(
            F.count(F.lit(1)).alias("words"), F.sum(F.bit_count("bits")).alias("rows")).collect()}
        written = 0
        for start, end in runs_of_files({n: r["words"] for n, r in found.items()}, len(files), words_per_copy):
            whole = spark.read.schema(schema).parquet(*[unquote(f["file"]) for f in files[start:end]]).select(
                "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
            block = F.shiftright(F.shiftleft("number", ROW_BITS) + F.col("row"), WORD_BITS)
            here = repeats.where(number.between(start, end - 1))
            marked = (whole.join(F.broadcast(numbers), "file").withColumn("block", block)
                      .join(F.broadcast(here), "block", "left"))
            once = marked.where(f"bits is null or getbit(bits, cast(row & {(1 << WORD_BITS) - 1} as int)) = 0")
            count = Observation(f"kept:{uuid.uuid4().hex}")
            (once.select(*schema.names).observe(count, F.count(F.lit(1)).alias("rows"))
             .write.mode("append").parquet(f"{aside}/kept"))
            written += count.get["rows"]
        if written + sum(r["rows"] for r in found.values()) != total:
            raise RuntimeError(f"batch {batch_id}: {written} messages kept of {total}, with "
                               f"{sum(r['rows'] for r in found.values())} repeats")
        publish_folder(spark, f"{aside}/kept", f"{path}/batch={batch_id}")
        delete(spark, aside)
    known = [t for t in (seen, *(f["seen"] for f in files)) if t is not None]
    publish_file(spark, f"{path}/{MARKS}/{batch_id:012d}.json", json.dumps({"seen": max(known, default=None)}))


def start_kept(spark: SparkSession, messages: str, schema: StructType, path: str, checkpoint: str,
               delay_seconds: int = DELAY_SECONDS, trigger: dict | None = None,
               query_name: str | None = None) -> StreamingQuery:
    """Start the stream that copies the stored ``messages``, each once, to ``path``."""
    located = spark.readStream.schema(schema).parquet(messages).select(
        *MESSAGE, "kafka_timestamp", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    w = (located.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, n: keep_batch(batch, n, path, schema, delay_seconds)))
    if query_name:
        w = w.queryName(query_name)
    return (w.trigger(**trigger) if trigger else w).start()


def kept_messages(spark: SparkSession, path: str) -> DataFrame:
    """The messages kept so far."""
    return spark.read.parquet(path).drop("batch")
