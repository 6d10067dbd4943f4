"""What a task holds, and how many files it writes, do not grow with the input."""

import re
from inspect import signature

from pyspark.sql import functions as F

from touchline.files import size_of
from touchline.plans import lineage as L
from touchline.operators.refine import SILVER_TABLES
from touchline.plans.workspace import land
from touchline.session import tune
from touchline.sinks.compact import FILE_BYTES, compact
from touchline.sinks.snapshots import snapshot
from touchline.sinks.upsert import upsert_newest
from touchline.sources.demo import LOG_ORDER, demo_records, log_stretches
from touchline.sources.stream import StreamSource
from touchline.sources.tables import read_table
from touchline.streaming.bronze import AVAILABLE_NOW, run_bronze, start_bronze
from touchline.streaming.dedupe import groups_for
from touchline.streaming.incremental import run_silver_streams


def tables(spark, folder, n):
    spark.range(n).selectExpr(
        "id as o_orderkey", "id * 7 as o_custkey", "substr('FOP', cast(id % 3 as int) + 1, 1) as o_orderstatus",
        "timestamp '1995-03-01' + make_interval(0, 0, 0, cast(id % 900 as int)) as o_orderdate").write.parquet(
        f"{folder}/orders.parquet")
    spark.range(n).selectExpr("id as event_id", "id % 50 as user_id",
                              "timestamp '2024-01-03' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as ts").write.parquet(
        f"{folder}/events.parquet")
    spark.range(5).selectExpr("cast(id as int) as r_regionkey", "concat('R', id) as r_name").write.parquet(
        f"{folder}/region.parquet")
    return folder


def test_stretches_grow_with_the_input_and_hold_every_record(spark, scratch):
    sf = tables(spark, scratch, 2000)
    for t in ("fixtures", "livescores", "events", "leagues"):
        cut = log_stretches(spark, sf, t, rows_per_file=100)
        assert cut.rdd.getNumPartitions() == (4 if t == "leagues" else 20)
        whole = demo_records(spark, sf, t)
        assert cut.schema == whole.schema
        assert cut.exceptAll(whole).count() == 0 and whole.exceptAll(cut).count() == 0
        # texts are made after the rows were dealt out: the plan's exchange is below its to_json
        plan = cut._jdf.queryExecution().optimizedPlan().toString()
        assert re.search("(?i)to_?json", plan).start() < plan.index("RepartitionByExpression")
        at = cut.select(F.struct("timestamp", "partition", "offset").alias("at"), F.spark_partition_id().alias("p"))
        ends = [(r.lo, r.hi) for r in at.groupBy("p").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).orderBy("p").collect()]
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert len(LOG_ORDER) == 3


def test_bronze_streams_write_without_sorting_whole_messages(spark, scratch):
    s = L.demo_settings(root=scratch)
    sf = tables(spark, f"{scratch}/sf", 300)
    demo_records(spark, sf, "events").write.parquet(f"{scratch}/landing")
    q = start_bronze(spark, "events", StreamSource(kind="files", path=f"{scratch}/landing"), s,
                     s.path("bronze", "events"), f"{scratch}/cp", AVAILABLE_NOW)
    assert q.awaitTermination(180)
    assert "Sort [" not in q._jsq.explainInternal(False)
    assert read_table(spark, s.path("bronze", "events")).count() == demo_records(spark, sf, "events").count()


def test_a_tasks_share_of_texts_is_bounded_and_stored_small(spark, scratch):
    """Splits and files of message texts stay small, whatever the table's size."""
    tune(spark)
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")) * 30 <= 1 << 30
    texts = spark.range(20_000).select(F.to_json(F.struct("id", *[F.lit("a name").alias(f"c{i}") for i in range(20)])).alias("j"))
    texts.coalesce(1).write.parquet(f"{scratch}/ours")
    texts.coalesce(1).write.option("compression", "snappy").parquet(f"{scratch}/snappy")
    assert size_of(spark, f"{scratch}/ours") < size_of(spark, f"{scratch}/snappy")


def test_a_merge_writes_one_file_per_range(spark, scratch):
    rows = spark.range(0, 400, 1, 8).selectExpr(
        "id as fixture_id", "timestamp '2024-01-01' as kafka_timestamp", "0 as kafka_partition", "id as kafka_offset",
        "0 as v")
    rows = rows.unionByName(rows.withColumn("v", F.lit(1)).withColumn("kafka_offset", F.col("kafka_offset") + 1000))
    none = spark.createDataFrame([], rows.schema).unionByName(rows.limit(1).withColumn("fixture_id", F.lit(None).cast("long")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in the batches of a stream
    try:
        path = f"{scratch}/newest"
        for more in (rows, rows.unionByName(none).where("fixture_id is null or fixture_id % 3 = 0")):
            upsert_newest(spark, path, more, "fixture_id", size=50)
            snap = snapshot(spark, path)
            files = [f.split("id_range=")[1].split("/")[0] for f in read_table(spark, path).inputFiles()]
            assert sorted(files) == sorted(v["id_range"] for v in snap.parts.values())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    got = read_table(spark, path)
    assert got.count() == 401 and got.where("v = 1").count() >= 400


def test_silver_streams_of_all_types_run_at_once(spark, scratch):
    s = L.demo_settings(root=scratch)
    sf = tables(spark, f"{scratch}/sf", 200)
    run_bronze(spark, {t: StreamSource(path=land(spark, sf, t, scratch)) for t in SILVER_TABLES}, s)
    ended = run_silver_streams(spark, s, SILVER_TABLES)
    assert set(ended) == {f"{p}{t}" for t in SILVER_TABLES.values() for p in ("", "dead_letters_")}
    for data_type, t in SILVER_TABLES.items():
        assert read_table(spark, s.path("silver_stream", t)).count() == L.silver(spark, sf, data_type, s).count()


def test_a_compacting_task_sorts_no_more_than_fits_it():
    assert FILE_BYTES * 30 <= 1 << 30 and signature(compact).parameters["file_bytes"].default == FILE_BYTES


def test_groups_follow_the_first_input_and_then_stay(spark, scratch):
    landed, kept = f"{scratch}/landed", f"{scratch}/_checkpoints/ttl_groups/events"
    records = demo_records(spark, tables(spark, f"{scratch}/sf", 400), "events")
    records.write.parquet(landed)
    n = records.count()
    assert groups_for(spark, landed, kept, messages_per_group=10) == -(-n // 10) > 8
    records.write.mode("append").parquet(landed)
    assert groups_for(spark, landed, kept, messages_per_group=10) == -(-n // 10)
    assert groups_for(spark, landed, f"{kept}-other", messages_per_group=10**6) == 8
