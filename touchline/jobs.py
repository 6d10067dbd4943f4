"""Command-line entry points of the three layer jobs.

    python -m touchline.jobs bronze --root R [--source kafka --servers B] [--once]
    python -m touchline.jobs silver --root R [--days-back 7] [--stream]
    python -m touchline.jobs gold   --root R [--days-back 30] [--stream]

``--root`` is the table root (a shared file system or object store path). Bronze reads
the four topics from Kafka (or replays landed broker records from ``R/landing/<type>``
with ``--source files``) and runs until stopped, or once over what is available with
``--once``. Silver and Gold print the rows written per table as JSON.
"""

from __future__ import annotations

import argparse
import json

from touchline.config import TOPICS, Settings
from touchline.plans.gold import run_gold
from touchline.functions.clock import day_before
from touchline.operators.refine import SILVER_TABLES
from touchline.plans.silver import run_silver
from touchline.session import build_session
from touchline.sinks.compact import compact
from touchline.sources.stream import StreamSource
from touchline.streaming.bronze import AVAILABLE_NOW, run_bronze
from touchline.streaming.incremental import run_silver_incremental


def _settings(a: argparse.Namespace) -> Settings:
    kw = dict(root=a.root, table_format=a.format, as_of=a.as_of)
    if a.cmd == "silver" and a.days_back is not None:
        kw["bronze_days_back"] = None if a.days_back < 0 else a.days_back
    if a.cmd == "gold" and a.days_back is not None:
        kw["silver_days_back"] = None if a.days_back < 0 else a.days_back
    if a.cmd == "bronze":
        kw["ingest_clock"] = a.ingest_clock
    if a.cmd == "gold" and a.stream:
        kw["silver_layer"] = "silver_stream"
    return Settings(**kw)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="touchline.jobs")
    p.add_argument("cmd", choices=["bronze", "silver", "gold", "compact"])
    p.add_argument("--root", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--as-of", default=None, help="pin the clock (UTC timestamp text)")
    p.add_argument("--days-back", type=int, default=None, help="lookback; -1 = all")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--servers", default="localhost:9092")
    p.add_argument("--max-per-trigger", type=int, default=None)
    p.add_argument("--ingest-clock", choices=["processing", "record"], default="processing")
    p.add_argument("--once", action="store_true", help="bronze: process what is available, stop")
    p.add_argument("--interval", default="30 seconds", help="bronze: micro-batch interval")
    p.add_argument("--stream", action="store_true",
                   help="silver: refine new Bronze files only; gold: read that Silver")
    a = p.parse_args(argv)

    spark = build_session(f"touchline-{a.cmd}")
    s = _settings(a)
    if a.cmd == "bronze":
        sources = {
            t: StreamSource(kind=a.source, topic=topic, servers=a.servers,
                            max_per_trigger=a.max_per_trigger,
                            path=s.path("landing", t))
            for t, topic in TOPICS.items()
        }
        trigger = AVAILABLE_NOW if a.once else {"processingTime": a.interval}
        print(json.dumps(run_bronze(spark, sources, s, trigger), default=str))
    elif a.cmd == "silver" and a.stream:
        print(json.dumps({t: run_silver_incremental(spark, s, dt, t)
                          for dt, t in SILVER_TABLES.items()}, default=str))
    elif a.cmd == "silver":
        print(json.dumps(run_silver(spark, s)))
    elif a.cmd == "compact":
        before = day_before(s.as_of, 0 if a.days_back is None else a.days_back)
        print(json.dumps({t: compact(spark, s.path("bronze", t), before, s.table_format) for t in TOPICS}))
    else:
        print(json.dumps(run_gold(spark, s)))


if __name__ == "__main__":
    main()
