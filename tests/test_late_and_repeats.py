"""Time-to-live skip, late messages, re-deliveries and windows on streams against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.files import exists
from touchline.operators.publish import skip_repeats as skip_in_batch
from touchline.streaming import late as T
from touchline.streaming import monitor as M
from touchline.streaming.bronze import AVAILABLE_NOW
from touchline.streaming.dedupe import judged, skip_repeats

TTL = 30 * 60
MINUTE = 60


def plain_skip(batches, ttl=TTL):
    """Messages (id, seconds) kept, batch by batch, in time order within a batch."""
    kept: dict = {}
    out = []
    for batch in batches:
        for i, t in sorted(batch):
            if all(abs(t - k) >= ttl for k in kept.setdefault(i, [])):
                kept[i].append(t)
                out.append((i, t))
    return sorted(out)


def messages(n, seed):
    rnd = random.Random(seed)
    return [(rnd.choice([1, 1, 1, 2, 3, 40]), rnd.randrange(0, 400) * MINUTE) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_judged_equals_brute_force(seed):
    rnd = random.Random(seed)
    rows = messages(300, seed)
    cuts = sorted(rnd.sample(range(1, 300), 4))
    batches = [rows[i:j] for i, j in zip([0, *cuts], [*cuts, 300])]
    held, out = [np.zeros(0, np.int64)] * 2, []
    for batch in batches:
        got = judged(*np.array(batch, np.int64).T, *held, TTL)
        held = [np.concatenate(c) for c in zip(held, got)]
        out += list(zip(*(c.tolist() for c in got)))
    assert sorted(out) == plain_skip(batches)
    for i, t in rows:  # a dropped one has a kept one near it, and kept ones are apart
        assert min(abs(t - k) for j, k in out if j == i) < TTL
    for i, t in out:
        assert all(j != i or k == t or abs(t - k) >= TTL for j, k in out)


def test_time_order_gives_the_pollers_rule_however_it_is_cut():
    rows = sorted(messages(300, 9), key=lambda r: r[1])
    rule, last = [], {}
    for i, t in rows:
        if t - last.get(i, -TTL) >= TTL:
            last[i] = t
            rule.append((i, t))
    for size in (1, 7, 300):
        assert plain_skip([rows[k:k + size] for k in range(0, 300, size)]) == sorted(rule)


def stream_run(spark, scratch, schema, operator, name="out"):
    q = (operator(spark.readStream.schema(schema).parquet(f"{scratch}/in")).writeStream.format("parquet")
         .trigger(**AVAILABLE_NOW).option("checkpointLocation", f"{scratch}/cp-{name}").start(f"{scratch}/{name}"))
    assert q.awaitTermination(180)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, s bigint").selectExpr(
        "'x' as data_type", "item_id", "timestamp_seconds(s) as kafka_timestamp")


def test_stream_with_late_messages_and_restarts(spark, scratch):
    schema = "data_type string, item_id bigint, kafka_timestamp timestamp"
    batches = [messages(120, 1) + [(None, 5), (None, 5)],
               [(1, 600 * MINUTE)],
               [(1, 540 * MINUTE), (1, 545 * MINUTE), (1, 570 * MINUTE), (1, 590 * MINUTE), (2, 900 * MINUTE)]]
    for batch in batches:
        items(spark, batch).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream_run(spark, scratch, schema, lambda s: skip_repeats(s, groups=4))
    got = [(r.item_id, int(r.kafka_timestamp.timestamp()))
           for r in spark.read.parquet(f"{scratch}/out").collect()]
    known = sorted(r for r in got if r[0] is not None)
    assert known == plain_skip([[r for r in b if r[0] is not None] for b in batches])
    # late pair: 540 stays, 545 repeats it; 570 lies exactly 30 minutes from 540 and from 600, so it stays
    assert {(1, m * MINUTE) for m in (540, 570, 600)} <= set(known)
    assert not {(1, m * MINUTE) for m in (545, 590)} & set(known)
    assert got.count((None, 5)) == 2


def test_forgotten_copies(spark, scratch):
    """With a horizon, state is bounded; only messages later than it can be kept beside a forgotten copy."""
    schema = "data_type string, item_id bigint, kafka_timestamp timestamp"
    for batch in ([(1, 0), (1, 1000 * MINUTE)], [(1, 5 * MINUTE), (1, 990 * MINUTE)]):
        items(spark, batch).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream_run(spark, scratch, schema, lambda s: skip_repeats(s, groups=1, horizon_seconds=3600))
    got = sorted(int(r.kafka_timestamp.timestamp()) // MINUTE for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == [0, 5, 1000]


def test_skip_in_batch_follows_the_rule(spark):
    rows = messages(300, 4)
    got = skip_in_batch(items(spark, rows + [(None, 1), (None, 1)]), ["data_type", "item_id"]).collect()
    known = sorted((r.item_id, int(r.kafka_timestamp.timestamp())) for r in got if r.item_id is not None)
    assert known == plain_skip([rows]) and len(got) == len(known) + 2


RECORD = "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp"


def records(spark, rows):
    return spark.createDataFrame(rows, "kafka_topic string, kafka_offset bigint, s bigint").selectExpr(
        "kafka_topic", "0 as kafka_partition", "kafka_offset", "timestamp_seconds(s) as kafka_timestamp")


def route(spark, scratch, delay):
    q = T.route_late(spark.readStream.schema(RECORD).parquet(f"{scratch}/in"), f"{scratch}/split",
                     f"{scratch}/cp-route", "kafka_timestamp", delay, AVAILABLE_NOW)
    assert q.awaitTermination(180)


def test_late_messages_are_routed_not_lost(spark, scratch):
    """kept + late + repeats is everything, and corrected windows are those of the whole."""
    rnd = random.Random(3)
    hour, origin = 3600, 400_000
    batches, done = [], []
    for start in (0, 40, 80):
        rows = [("t", 10_000 * start + i, (origin + start + rnd.randrange(30)) * hour + rnd.randrange(hour)) for i in range(60)]
        rows += rnd.sample(rows, 8)                                    # copies at once
        rows += rnd.sample(done, min(9, len(done)))                    # copies, late or not
        rows += [("t", 10_000 * start + 5000 + i, (origin + rnd.randrange(max(1, start))) * hour) for i in range(7)]  # late, new
        batches.append(rows)
        done += rows
    for rows in batches:
        records(spark, rows).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        route(spark, scratch, 5 * hour)
        on_time = spark.readStream.schema(RECORD)
        for name, operator in (("kept", M.without_redeliveries), ("windows", M.window_counts)):
            q = (operator(on_time.parquet(f"{scratch}/split/on_time"), delay_seconds=5 * hour).writeStream
                 .format("parquet").trigger(**AVAILABLE_NOW).option("checkpointLocation", f"{scratch}/cp-{name}")
                 .start(f"{scratch}/{name}"))
            assert q.awaitTermination(180)
    seen, on, late = None, [], []
    for rows in batches:
        for r in rows:
            (late if seen is not None and r[2] <= seen - 5 * hour else on).append(r)
        seen = max([r[2] for r in rows] + ([seen] if seen else []))
    kept = spark.read.parquet(f"{scratch}/kept")
    late_df = T.late_rows(spark, f"{scratch}/split", RECORD)
    assert sorted(r.kafka_offset for r in kept.collect()) == sorted({r[1] for r in on})
    assert sorted(r.kafka_offset for r in late_df.collect()) == sorted(r[1] for r in late) and len(late) > 10
    report = M.redelivery_report(kept, late_df, records(spark, done)).first()
    unseen = {r[1] for r in late} - {r[1] for r in on}
    assert (report["messages"], report["kept"], report["late"], report["repeats"]) == (
        len(done), len({r[1] for r in on}), len(unseen), len(done) - len({r[1] for r in done}))
    got = {r.window_start_epoch: (r.messages, r.late) for r in M.corrected_counts(
        spark.read.parquet(f"{scratch}/windows"), late_df).collect()}
    every, some = Counter(r[2] // hour * hour for r in done), Counter(r[2] // hour * hour for r in late)
    last = max(got)
    assert got == {w: (n, some[w]) for w, n in every.items() if w <= last}
    assert last + hour <= seen - 5 * hour


def test_a_batch_that_is_run_again_changes_nothing(spark, scratch, monkeypatch):
    first, second = records(spark, [("t", 1, 0), ("t", 2, 9000)]), records(spark, [("t", 3, 10), ("t", 4, 9500)])
    T.split_batch(first, 0, f"{scratch}/s", "kafka_timestamp", 3600)

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(T, "publish_file", lost)
    with pytest.raises(RuntimeError):  # both tables have the batch, its mark is missing
        T.split_batch(second, 1, f"{scratch}/s", "kafka_timestamp", 3600)
    monkeypatch.undo()
    for _ in range(2):
        T.split_batch(second, 1, f"{scratch}/s", "kafka_timestamp", 3600)
    assert [r.kafka_offset for r in T.late_rows(spark, f"{scratch}/s", RECORD).collect()] == [3]
    on = spark.read.schema(RECORD).parquet(f"{scratch}/s/on_time")
    assert sorted(r.kafka_offset for r in on.collect()) == [1, 2, 4]
    assert T.mark_before(spark, f"{scratch}/s", 2) == 9_500_000_000
    assert not exists(spark, f"{scratch}/s/_aside/1")


def test_dashboard_follows_the_stream_across_a_restart(spark, scratch, monkeypatch):
    from touchline.operators import analytics as A
    from touchline.plans import lineage as L
    from touchline.streaming import dashboard as D
    from tests.conftest import SF_SMALL
    s = L.demo_settings(root=scratch)
    silver = L.silver(spark, SF_SMALL, "livescores", s)
    path = s.path("silver_stream", "live_scores")
    parts = [silver.where(F.col("kafka_offset") % 3 == k) for k in (2, 0, 1)]  # newest polls first
    parts[0].coalesce(2).write.mode("append").parquet(path)
    D.run_dashboard(spark, s, max_files=1)
    # the second run merges a batch and dies before the stream learns of it
    parts[1].coalesce(1).write.mode("append").parquet(path)
    real = D.merge_batch

    def dies(batch, batch_id, *rest):
        real(batch, batch_id, *rest)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(D, "merge_batch", dies)
    with pytest.raises(Exception):
        D.run_dashboard(spark, s, max_files=1)
    monkeypatch.setattr(D, "merge_batch", real)
    parts[2].coalesce(1).write.mode("append").parquet(path)
    D.run_dashboard(spark, s, max_files=1)
    got = D.current_dashboard(spark, s)
    want = A.live_dashboard(L.current(silver, "live_scores", s), s).select(*got.columns)
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    from touchline.sinks.snapshots import snapshot
    version = snapshot(spark, s.path("dashboard", "newest_live")).version
    D.run_dashboard(spark, s)  # nothing new
    assert snapshot(spark, s.path("dashboard", "newest_live")).version == version
