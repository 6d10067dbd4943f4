"""Time-to-live de-duplication of polled items as a streaming query.

An item (data type, id) polled again less than 30 minutes from a kept copy is dropped, as the poller
does. Messages are judged batch by batch, in time order within a batch, against all copies kept
so far, on both sides: whatever order messages arrive in, kept copies of an item are at
least 30 minutes apart, and each dropped one lies less than 30 minutes from a kept one. For messages in time order that is
the poller's rule. Messages without an id are kept.

Items are dealt to a fixed number of groups. The state of a group is the kept times of all its
items, as two packed columns, so that one call judges many items at once, without a frame or a state
entry per item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from touchline.config import Settings
from touchline.files import exists, publish_file, read_text
from touchline.operators.ingest import decode_records
from touchline.operators.publish import TTL_SECONDS
from touchline.plans.workspace import land, land_late
from touchline.schemas import KAFKA_RECORD
from touchline.sinks.tables import stream_append
from touchline.sources.stream import StreamSource, record_stream
from touchline.streaming.bronze import AVAILABLE_NOW, await_all

ITEM = "data_type string, item_id bigint, kafka_timestamp timestamp"


def near_kept(ids: np.ndarray, times: np.ndarray, kept: np.ndarray, ttl: int) -> np.ndarray:
    """Rows (sorted by id and time) with a kept row of their id less than ``ttl`` away."""
    n = len(ids)
    place = np.arange(n)
    before = np.maximum.accumulate(np.where(kept, place, -1))
    after = np.minimum.accumulate(np.where(kept, place, n)[::-1])[::-1]
    near = np.zeros(n, bool)
    for at, there in ((before, before >= 0), (after, after < n)):
        at = np.where(there, at, 0)
        near |= there & (ids[at] == ids) & (np.abs(times - times[at]) < ttl)
    return near


def judged(ids: np.ndarray, times: np.ndarray, kept_ids: np.ndarray, kept_times: np.ndarray,
           ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, times) to keep of a batch, given all copies kept before.

    Per item in time order: the earliest open message is kept, and what is near it drops; all items
    take their steps together.
    """
    all_ids, all_times = np.concatenate([kept_ids, ids]), np.concatenate([kept_times, times])
    kept = np.arange(len(all_ids)) < len(kept_ids)
    o = np.lexsort((all_times, all_ids))
    all_ids, all_times, kept = all_ids[o], all_times[o], kept[o]
    new = ~kept
    out_ids, out_times = [], []
    open_ = new & ~near_kept(all_ids, all_times, kept, ttl)
    while open_.any():
        at = np.flatnonzero(open_)
        first = at[np.concatenate([[True], all_ids[at[1:]] != all_ids[at[:-1]]])]
        kept[first] = True
        out_ids.append(all_ids[first])
        out_times.append(all_times[first])
        open_ &= ~near_kept(all_ids, all_times, kept, ttl)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_ids]), np.concatenate([none, *out_times])


def skip_repeats(items: DataFrame, ttl_seconds: int = TTL_SECONDS, groups: int = 64,
                 horizon_seconds: int | None = None) -> DataFrame:
    """A stream of items (data_type, item_id, kafka_timestamp) without repeats.

    ``groups`` is part of the state and stays as it is for the life of a stream: at least as many as its
    largest cluster has cores, and so many that a group's share of a batch and its kept items fit a worker's
    memory (``groups_for``). ``horizon_seconds`` forgets kept copies that are so much older than the newest of their group:
    a message that comes later than that may be kept beside a forgotten one. Leave
    it None for runs over bounded input.
    """
    ttl = ttl_seconds * 1_000_000

    def judge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frames = [p[["item_id", "t"]].to_numpy(np.int64) for p in parts]
        batch = np.concatenate(frames)
        held = [np.frombuffer(x, np.int64) for x in state.get] if state.exists else [np.zeros(0, np.int64)] * 2
        ids, times = judged(batch[:, 0], batch[:, 1], *held, ttl)
        held = [np.concatenate(c) for c in zip(held, (ids, times))]
        if horizon_seconds is not None:
            young = held[1] >= held[1].max() - max(horizon_seconds * 1_000_000, ttl)
            held = [c[young] for c in held]
        state.update(tuple(c.tobytes() for c in held))
        if len(ids):
            yield pd.DataFrame({"data_type": key[0], "item_id": ids, "t": times})

    timed = items.select("data_type", "item_id", F.unix_micros("kafka_timestamp").alias("t"))
    dealt = timed.where("item_id is not null").withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    known = dealt.groupBy("data_type", "part").applyInPandasWithState(
        judge, "data_type string, item_id bigint, t bigint", "ids binary, times binary", "append",
        GroupStateTimeout.NoTimeout)
    return known.union(timed.where("item_id is null")).select(
        "data_type", "item_id", F.timestamp_micros("t").alias("kafka_timestamp"))


def polled_items(records: DataFrame, data_type: str) -> DataFrame:
    """(data_type, item_id, kafka_timestamp) of broker records."""
    return decode_records(records).select(
        F.lit(data_type).alias("data_type"),
        F.get_json_object("raw_json", "$.id").try_cast("bigint").alias("item_id"), "kafka_timestamp")


MESSAGES_PER_GROUP = 1 << 17  # what a call has in memory, whatever the input


def groups_for(spark: SparkSession, landed: str, kept: str, messages_per_group: int = MESSAGES_PER_GROUP) -> int:
    """Groups of a stream: as many as the messages that have landed before its first run ask for, and at least
    one a core. Written to ``kept`` then, as later runs must deal items as the first one did."""
    if not exists(spark, kept):
        messages = spark.read.schema(KAFKA_RECORD).parquet(landed).count()
        groups = max(8, spark.sparkContext.defaultParallelism, -(-messages // messages_per_group))
        publish_file(spark, kept, str(groups))
    return int(read_text(spark, kept))


def run_ttl_dedup(spark: SparkSession, sf_dir: str, settings: Settings,
                  data_types: tuple[str, ...] = ("fixtures", "livescores", "leagues", "events")) -> str:
    """Two runs of each stream: over the landed records, then over those that arrive late."""
    out = settings.path("ttl_dedup")
    paths = {t: land(spark, sf_dir, t, settings.root) for t in data_types}
    groups = {t: groups_for(spark, p, settings.path("_checkpoints", "ttl_groups", t)) for t, p in paths.items()}
    for late in (False, True):
        if late:
            land_late(spark, sf_dir, settings.root, "late_ttl")
        queries = {}
        for data_type, path in paths.items():
            either = path.replace("/landing/", "/{landing,late_ttl}/")
            items = polled_items(record_stream(spark, StreamSource(kind="files", path=either)), data_type)
            queries[data_type] = stream_append(
                skip_repeats(items, groups=groups[data_type]), f"{out}/{data_type}",
                settings.path("_checkpoints", "ttl_dedup", data_type), "parquet", partition_by=(),
                trigger=AVAILABLE_NOW, query_name=f"ttl_dedup_{data_type}")
        await_all(spark, queries)
    return out
