"""SQL access: Gold tables as temporary views (newest daily snapshot only)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from touchline.config import Settings
from touchline.plans.gold import GOLD_SORT
from touchline.sources.tables import read_table


def register_views(spark: SparkSession, settings: Settings, tables=tuple(GOLD_SORT)) -> list[str]:
    """One view per Gold table showing the snapshot of its newest run only.

    Gold keeps one snapshot per processing day; a reader of all partitions would count every
    team once per day. The run log names the newest snapshot also when it has no rows: a
    dashboard without live matches shows none, not those of the day before. A view shows the
    tables as they are when it is registered; register it again after a run.
    """
    log = settings.path("gold", "run_log")
    for t in tables:
        name = f"{t}_all_days"
        read_table(spark, settings.path("gold", t), settings.table_format).createOrReplaceTempView(name)
        spark.sql(f"""
            create or replace temporary view {t} as
            select * from {name}
            where make_date(year, month, day) =
                  (select to_date(max(run_at)) from parquet.`{log}` where table_name = '{t}')""")
    return list(tables)
