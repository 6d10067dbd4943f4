"""Match coverage on streams: fixtures joined with their first live score within a bound of time.

Both sides have a watermark. A fixture poll comes out as covered as soon as a live score of
its game arrives at most ``bound`` after it, or once, as not covered, when the watermark has passed that bound.

Spark's join of streams keeps both sides of a batch in its state, row by row. Runs over stored Silver (``start_coverage``)
judge a batch by one sort of both sides instead, which spills to disk, and store what is still open.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.config import Settings
from touchline.files import children, delete, exists, publish_file, publish_folder, read_text
from touchline.functions.clock import now
from touchline.operators.snapshot import BROKER_ORDER
from touchline.session import release
from touchline.streaming.bronze import AVAILABLE_NOW, await_all
from touchline.streaming.late import MARKS

BOUND = "3 days"
DELAY = "1 hour"
HEARTBEATS = {"fixtures": -1, "live_scores": -2}  # ids that meet no game, and not each other
FIXTURE = ["fixture_id", "league_id", "season_id", "starting_at", *BROKER_ORDER]
SIDES = {"fixtures": FIXTURE, "live_scores": ["fixture_id", "kafka_timestamp"]}  # what is read of each
ROWS_PER_TASK = 1 << 20


def within(bound: str) -> Column:
    """The last time at which a live score covers a poll."""
    return F.col("kafka_timestamp") + F.expr(f"interval {bound}")


def covered_fixtures(fixtures: DataFrame, live_scores: DataFrame, bound: str = BOUND, delay: str = DELAY,
                     tasks: int | None = None) -> DataFrame:
    """A stream of fixture polls (``FIXTURE``) with ``covered``; of stored rows, every poll, judged by all live scores.

    Heartbeats pass through: a filter after the join would be moved below the watermarks that they drive.
    """
    if not fixtures.isStreaming:
        return judged(fixtures, live_scores, bound, tasks)
    first = (live_scores.select(F.col("fixture_id").alias("game"), F.col("kafka_timestamp").alias("seen_at"))
             .withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["game"]))
    polls = fixtures.select(*FIXTURE).withWatermark("kafka_timestamp", delay)
    joined = polls.join(first, (polls["fixture_id"] == first["game"]) & (first["seen_at"] >= polls["kafka_timestamp"])
                        & (first["seen_at"] <= polls["kafka_timestamp"] + F.expr(f"interval {bound}")), "left_outer")
    return joined.select(*FIXTURE, F.col("game").isNotNull().alias("covered"))


def judged(fixtures: DataFrame, live_scores: DataFrame, bound: str = BOUND, tasks: int | None = None) -> DataFrame:
    """Stored polls with ``covered``: one pass over each game, newest first, remembers its next live score."""
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in fixtures.select(*FIXTURE).schema
            if f.name not in ("fixture_id", "kafka_timestamp")]
    polls = fixtures.select(*FIXTURE, F.lit(None).cast("timestamp").alias("seen_at"), F.lit(1).alias("side"))
    live = (live_scores.where("fixture_id is not null and kafka_timestamp is not null")
            .select("fixture_id", "kafka_timestamp", *rest, F.col("kafka_timestamp").alias("seen_at"), F.lit(0).alias("side")))
    # polls that meet no live score are dealt out, not gathered as one game
    alone = F.when(F.col("fixture_id").isNull() | F.col("kafka_timestamp").isNull(),
                   F.coalesce(F.pmod("kafka_offset", F.lit(4096)), F.lit(0)))
    both = polls.unionByName(live).withColumn("alone", alone)
    game = ["fixture_id", "alone"]
    both = both.repartition(tasks, *game) if tasks else both.repartition(*game)
    newest_first = (Window.partitionBy(*game).orderBy(F.desc("kafka_timestamp"), "side")
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = both.withColumn("following", F.last("seen_at", ignorenulls=True).over(newest_first)).where("side = 1")
    return following.select(*FIXTURE, F.coalesce(F.col("following") <= within(bound), F.lit(False)).alias("covered"))


def seen_before(spark: SparkSession, path: str, batch_id: int) -> dict[str, int | None]:
    """The newest time (microseconds) of each side in the batches before this one, and the newest of those batches."""
    before = [n for n in children(spark, f"{path}/{MARKS}") if n.endswith(".json") and int(n.split(".")[0]) < batch_id]
    return json.loads(read_text(spark, f"{path}/{MARKS}/{max(before)}")) if before else {}


def watermark(seen: dict[str, int | None], delay: str) -> Column:
    """The older of both sides' newest times, less the delay; NULL until both sides have come."""
    times = [seen.get(side) for side in HEARTBEATS]
    if None in times:
        return F.lit(None).cast("timestamp")
    return F.timestamp_micros(F.lit(min(times))) - F.expr(f"interval {delay}")


def cover_batch(batch: DataFrame, batch_id: int, path: str, bound: str = BOUND, delay: str = DELAY) -> None:
    """Write the polls that a batch settles, and what stays open after it: polls, and live scores that a later poll can meet.

    As in a join of streams, rows older than the watermark of the batches before are dropped. Folders are
    named by the batch and moved into place when they are complete.
    """
    spark = batch.sparkSession
    if exists(spark, f"{path}/{MARKS}/{batch_id:012d}.json"):
        return
    before = seen_before(spark, path, batch_id)
    fresh = batch.where(F.coalesce(F.col("kafka_timestamp") > watermark(before, delay), F.lit(True)))
    came = {r["source"]: r for r in batch.groupBy("source").agg(
        F.max(F.unix_micros("kafka_timestamp")).alias("seen"), F.count(F.lit(1)).alias("rows")).collect()}
    seen = {side: max([t for t in (before.get(side), came[side]["seen"] if side in came else None) if t is not None],
                      default=None) for side in HEARTBEATS}
    sides = {side: fresh.where(F.col("source") == side).select(*columns) for side, columns in SIDES.items()}
    if "batch" in before:
        for side, rows in sides.items():
            sides[side] = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/open/batch={before['batch']}/{side}"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(r["rows"] for r in came.values()) // ROWS_PER_TASK))
    now_ = watermark(seen, delay)
    settled = F.col("covered") | F.coalesce(within(bound) <= now_, F.lit(False))
    aside = f"{path}/_aside/{batch_id}-{uuid.uuid4().hex[:12]}"
    polls = covered_fixtures(sides["fixtures"], sides["live_scores"], bound, delay, tasks).withColumn(
        "went", F.when(settled, F.lit("polls")).otherwise(F.lit("open")))
    polls.write.partitionBy("went").parquet(f"{aside}/fixtures")
    for went, to in (("polls", "polls"), ("open", "open/fixtures")):
        if exists(spark, f"{aside}/fixtures/went={went}"):
            publish_folder(spark, f"{aside}/fixtures/went={went}", f"{aside}/{to}")
        else:
            spark.createDataFrame([], polls.drop("went").schema).write.parquet(f"{aside}/{to}")
    (sides["live_scores"].where(F.coalesce(F.col("kafka_timestamp") > now_, F.col("kafka_timestamp").isNotNull()))
     .write.parquet(f"{aside}/open/live_scores"))
    publish_folder(spark, f"{aside}/open", f"{path}/open/batch={batch_id}")
    publish_folder(spark, f"{aside}/polls", f"{path}/polls/batch={batch_id}")
    publish_file(spark, f"{path}/{MARKS}/{batch_id:012d}.json", json.dumps(seen | {"batch": batch_id}))
    delete(spark, aside)
    if "batch" in before:
        delete(spark, f"{path}/open/batch={before['batch']}")
    release(spark)


def start_coverage(fixtures: DataFrame, live_scores: DataFrame, path: str, checkpoint: str, bound: str = BOUND,
                   delay: str = DELAY, trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start the stream that judges stored polls (``path``/polls) by stored live scores."""
    both = fixtures.select(*FIXTURE, F.lit("fixtures").alias("source")).unionByName(
        live_scores.select(*SIDES["live_scores"], F.lit("live_scores").alias("source")), allowMissingColumns=True)
    w = (both.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, n: cover_batch(batch, n, path, bound, delay)))
    if query_name:
        w = w.queryName(query_name)
    return (w.trigger(**trigger) if trigger else w).start()


def settled_polls(spark: SparkSession, path: str) -> DataFrame:
    """The polls settled so far (``FIXTURE``) with ``covered``."""
    return spark.read.parquet(path).drop("batch")


def coverage(polls: DataFrame, settings: Settings) -> DataFrame:
    """Per league and season: kicked-off fixtures (by their newest poll) and how many are covered."""
    rest = F.struct("starting_at", "league_id", "season_id")
    polls = polls.where(F.coalesce(F.col("fixture_id") != HEARTBEATS["fixtures"], F.lit(True)))
    games = (polls.groupBy("fixture_id").agg(F.max_by(rest, F.struct(*BROKER_ORDER)).alias("poll"),
                                             F.max("covered").alias("covered"))
             .select("fixture_id", "poll.*", "covered")
             .where(F.try_to_timestamp("starting_at") <= now(settings.as_of)))
    return (games.groupBy("league_id", "season_id")
            .agg(F.count(F.lit(1)).alias("fixtures"), F.count_if("covered").alias("covered"))
            .withColumn("coverage", F.col("covered") / F.col("fixtures")))


def run_coverage(spark: SparkSession, settings: Settings, heartbeat: str | None = None) -> str:
    """One run over incremental Silver; returns the folder of the covered polls.

    ``heartbeat`` (a time) tells both sides that the clock has come so far although nothing
    was polled: an idle side would hold the watermark, and with it open fixtures, back.
    """
    out = settings.path("coverage")
    sides = {}
    for table in ("fixtures", "live_scores"):
        beats = f"{out}/heartbeats/{table}"
        path = settings.path("silver_stream", table)
        columns = SIDES[table]
        schema = spark.read.format(settings.table_format).load(path).schema
        empty = spark.createDataFrame([], schema).select(*columns)
        beat = spark.createDataFrame([(None,) * len(columns)] if heartbeat else [], empty.schema)
        (beat.withColumns({"kafka_timestamp": F.lit(heartbeat).cast("timestamp"),
                           "fixture_id": F.lit(HEARTBEATS[table]).cast("bigint")})
         .write.mode("append").parquet(beats))
        rows = spark.readStream.schema(schema).format(settings.table_format).load(path).select(*columns)
        sides[table] = rows.union(spark.readStream.schema(empty.schema).parquet(beats))
    query = start_coverage(sides["fixtures"], sides["live_scores"], out, settings.path("_checkpoints", "coverage"),
                           trigger=AVAILABLE_NOW, query_name="coverage")
    await_all(spark, {"coverage": query})
    return f"{out}/polls"
