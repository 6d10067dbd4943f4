"""Re-deliveries dropped from batches of any size: no state, narrow shuffles, exactly once."""

import random
import time

import pytest

from touchline.files import children, exists, size_of
from touchline.plans.workspace import land
from touchline.session import release
from touchline.streaming import redeliveries as K
from touchline.streaming.bronze import AVAILABLE_NOW
from tests.test_scale import tables

HOUR = 3600
WHOLE = "kafka_key string, raw_json string, kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp"


def schema_of(spark, ddl=WHOLE):
    return spark.createDataFrame([], ddl).schema


def messages(spark, rows):
    return spark.createDataFrame(rows, "kafka_topic string, kafka_partition int, kafka_offset bigint, s bigint").selectExpr(
        "'k' as kafka_key", "concat('text of ', kafka_topic, kafka_offset, repeat('x', 300)) as raw_json", "kafka_topic",
        "kafka_partition", "kafka_offset", "timestamp_seconds(s) as kafka_timestamp")


def keep(spark, folder, delay=5 * HOUR):
    q = K.start_kept(spark, f"{folder}/in", schema_of(spark), f"{folder}/kept", f"{folder}/cp", delay, AVAILABLE_NOW)
    assert q.awaitTermination(180)
    return q


def test_each_message_is_kept_whole_and_once(spark, scratch, monkeypatch):
    rnd, folder = random.Random(5), f"{scratch}/with space"
    monkeypatch.setattr(K.keep_batch, "__defaults__", (2,))  # several copying jobs
    done = []
    for start in (0, 3, 6):
        rows = [(rnd.choice("tu"), rnd.randrange(3), 1000 * start + i, (start * 10 + 400_000) * HOUR + i) for i in range(300)]
        rows = rows + rnd.sample(rows, 60) + [rows[0]] * 70 + rnd.sample(done[-400:], min(len(done), 20))
        rows += [(None, 1, 1000 * start, 400_000 * HOUR)] * 2 + [("t", None, 1000 * start, None)] * 2
        rnd.shuffle(rows)
        messages(spark, rows).repartition(3).write.mode("append").parquet(f"{folder}/in")
        keep(spark, folder, delay=40 * HOUR)
        done += rows
        got = K.kept_messages(spark, f"{folder}/kept")
        assert got.schema == schema_of(spark)
        want = messages(spark, sorted({repr(r): r for r in done}.values(), key=repr))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert children(spark, f"{folder}/kept/_aside") == []


def test_messages_are_forgotten_as_a_watermark_forgets_them(spark, scratch):
    day = 400_000 * HOUR
    for rows in ([("t", 0, 1, day), ("t", 0, 2, day + 11 * HOUR), ("t", 0, 3, day + 20 * HOUR)],
                 [("t", 0, 1, day), ("t", 0, 2, day + 11 * HOUR)]):
        messages(spark, rows).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        keep(spark, scratch)  # of 20 hours, five and five are remembered
    got = sorted(r.kafka_offset for r in K.kept_messages(spark, f"{scratch}/kept").collect())
    assert got == [1, 1, 2, 3]


def test_texts_are_neither_shuffled_nor_remembered(spark, scratch):
    rows = [("t", 0, i, 400_000 * HOUR + i) for i in range(5000)]
    messages(spark, rows + rows[:50]).repartition(2).write.parquet(f"{scratch}/in")
    q = keep(spark, scratch)
    assert not exists(spark, f"{scratch}/cp/state")
    assert "raw_json" not in q._jsq.explainInternal(False).split("Physical Plan")[-1].split("ReadSchema")[-1].split("\n")[0]
    assert size_of(spark, f"{scratch}/kept/batch=0") < 1.5 * size_of(spark, f"{scratch}/in")


def test_a_batch_of_messages_that_is_run_again_changes_nothing(spark, scratch, monkeypatch):
    rows = [("t", 0, i % 40, 400_000 * HOUR) for i in range(60)]
    messages(spark, rows).coalesce(1).write.parquet(f"{scratch}/in")
    real = K.publish_file

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(K, "publish_file", lost)
    with pytest.raises(Exception):
        keep(spark, scratch)
    monkeypatch.setattr(K, "publish_file", real)
    for _ in range(2):
        keep(spark, scratch)
    assert K.kept_messages(spark, f"{scratch}/kept").count() == 40


def test_files_are_dealt_to_copying_jobs_by_their_repeats():
    assert list(K.runs_of_files({0: 3, 1: 3, 3: 9, 4: 1}, 6, 6)) == [(0, 3), (3, 4), (4, 6)]
    assert list(K.runs_of_files({}, 4, 6)) == [(0, 4)] and list(K.runs_of_files({}, 0, 6)) == []


def test_landing_leaves_no_shuffle_files(spark, scratch, monkeypatch):
    from touchline.plans import workspace
    calls = []
    monkeypatch.setattr(workspace, "release", lambda s: calls.append(s))
    land(spark, tables(spark, f"{scratch}/sf", 50), "events", f"{scratch}/root")
    land(spark, f"{scratch}/sf", "events", f"{scratch}/root")
    assert calls == [spark]


def test_a_release_deletes_shuffle_files(spark):
    def shuffled():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        return env.blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")

    def job():
        assert spark.range(1000).repartition(7, "id").groupBy("id").count().count() == 1000

    release(spark)
    time.sleep(3)
    before = shuffled()
    job()
    assert shuffled() > before
    end = time.time() + 30  # Python lets go of its frames a little later than they end
    while shuffled() > before and time.time() < end:
        time.sleep(1)
        release(spark)
    assert shuffled() <= before
