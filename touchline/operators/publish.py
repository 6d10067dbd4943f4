"""The poller's data steps as DataFrame operators (the REST poller itself is not built).

Pages of the API are unwrapped, objects are stamped with a ``_metadata`` envelope, live
games fan out into one message per embedded event, fixtures are selected by kick-off
window, repeats are dropped within a time-to-live, and each fetch is summarised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.config import Settings
from touchline.functions.clock import now
from touchline.operators.refine import DROPPED_REASONS, MSG, REASON, parsed_with_reason
from touchline.operators.snapshot import SNAPSHOT_KEYS, latest_snapshot
from touchline.schemas import LIVE_SCORE_DDL, PAGE_DDL

API_VERSION = "v3"  # fixed value: the API version the envelope names


def explode_page(pages: DataFrame, text: str = "page") -> DataFrame:
    """One row per object of a page's ``data`` array (kept as JSON text); none if missing."""
    data = F.from_json(F.col(text), PAGE_DDL)["data"]
    items = F.coalesce(data, F.array().cast("array<string>"))
    keep = [c for c in pages.columns if c != text]
    return pages.select(*keep, F.posexplode(items).alias("item_position", "item_json"))


def envelope(kind: str, settings: Settings, source: str = "demo") -> Column:
    """The ``_metadata`` struct the poller adds to every object."""
    return F.struct(F.lit(source).alias("source"), F.lit(kind).alias("type"),
                    F.date_format(now(settings.as_of), "yyyy-MM-dd'T'HH:mm:ss")
                    .alias("fetched_at"),
                    F.lit(API_VERSION).alias("api_version"))


def with_envelope(objects: DataFrame, kind: str, settings: Settings) -> DataFrame:
    return objects.withColumn("_metadata", envelope(kind, settings))


def event_fanout(live_bronze: DataFrame, settings: Settings) -> DataFrame:
    """One event message per event embedded in a live-score message.

    Key ``<game id>_<event id>``; the game's id goes into the event's ``_metadata``.
    """
    p = parsed_with_reason(live_bronze, LIVE_SCORE_DDL)
    p = p.filter(F.col(REASON).isNull() | ~F.col(REASON).isin(*DROPPED_REASONS))
    game = F.col(f"{MSG}.id")
    ev = p.select(game.alias("fixture_id"), "kafka_offset",
                  F.posexplode(F.col(f"{MSG}.events")).alias("event_position", "event"))
    event_id = F.try_element_at(F.col("event"), F.lit("id")).try_cast("bigint")
    meta = F.struct(F.lit("demo").alias("source"), F.lit("event").alias("type"),
                    F.col("fixture_id").alias("fixture_id"),
                    F.date_format(now(settings.as_of), "yyyy-MM-dd'T'HH:mm:ss")
                    .alias("fetched_at"), F.lit(API_VERSION).alias("api_version"))
    return ev.select(
        F.concat_ws("_", F.col("fixture_id").cast("string"), event_id.cast("string"))
        .alias("key"),
        "fixture_id", "kafka_offset", "event_position", event_id.alias("event_id"),
        F.try_element_at(F.col("event"), F.lit("type_id")).try_cast("int").alias("type_id"),
        _with_member(F.to_json(F.col("event")), "_metadata", F.to_json(meta)).alias("value"))


def _with_member(obj_json: Column, name: str, value_json: Column) -> Column:
    """Add a member to the JSON object text ``obj_json`` (as written by ``to_json``)."""
    member = F.concat(F.lit(f'"{name}":'), value_json)
    head = F.substring(obj_json, F.lit(1), F.length(obj_json) - 1)
    return (F.when(obj_json == "{}", F.concat(F.lit("{"), member, F.lit("}")))
            .otherwise(F.concat(head, F.lit(","), member, F.lit("}"))))


def upcoming_fixtures(fixtures: DataFrame, settings: Settings, hours: int = 24) -> DataFrame:
    """Fixtures whose newest poll kicks off within ``[now, now + hours]``."""
    fixtures = latest_snapshot(fixtures, SNAPSHOT_KEYS["fixtures"])
    start = F.try_to_timestamp(F.col("starting_at"))
    t0 = now(settings.as_of)
    return fixtures.filter(start.between(t0, F.timestamp_add("HOUR", F.lit(hours), t0)))


TTL_SECONDS = 30 * 60  # fixed value: the poller's time to live


def skip_repeats(items: DataFrame, keys: list[str], time_col: str = "kafka_timestamp",
                 ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Batch form of the time-to-live skip over a whole history: of an item's times, in order, one is kept
    unless a kept one lies less than the time to live before it. Rows: keys and ``time_col``.

    The times of an item are folded on its group's sorted distinct times (its polls, never whole messages);
    rows whose first key is null have no identity and are all kept.
    """
    t = F.unix_micros(time_col)
    ttl = F.lit(ttl_seconds * 1_000_000)
    known = items.where(" and ".join(f"{k} is not null" for k in keys))
    folded = F.aggregate(
        F.array_sort("times"),
        F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("kept")),
        lambda acc, x: F.when(acc["last"].isNull() | (x - acc["last"] >= ttl),
                              F.struct(x.alias("last"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc),
        lambda acc: acc["kept"])
    kept = (known.groupBy(*keys).agg(F.collect_set(t).alias("times"))
            .select(*keys, F.explode(folded).alias("t")))
    others = items.where(" or ".join(f"{k} is null" for k in keys)).select(*keys, t.alias("t"))
    return kept.unionByName(others).select(*keys, F.timestamp_micros("t").alias(time_col))


def fetch_summary(live_scores: DataFrame) -> DataFrame:
    """Per fetch day: live-score messages, distinct games, events they carried."""
    return (live_scores.groupBy(F.to_date("kafka_timestamp").alias("fetch_date"))
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.count_distinct("fixture_id").alias("games"),
                 F.sum("events_count").cast("bigint").alias("events")))
