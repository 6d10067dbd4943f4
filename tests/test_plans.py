"""Plan shape: one JSON parse, one scan for the home/away rows, no Python UDF,
lookback reaches the partition filter."""

from touchline.operators import analytics as A
from touchline.plans import lineage as L
from touchline.sinks.tables import write_table
from touchline.sources.tables import read_bronze
from tests.conftest import SF_SMALL

S = L.demo_settings()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_from_json_per_row(spark):
    plan = physical(L.silver(spark, SF_SMALL, "livescores", S))
    assert plan.count("from_json(") == 1


def test_team_rows_scan_once(spark):
    df = A.team_match_rows(L.match_results(spark, SF_SMALL, S))
    plan = physical(df)
    assert "Union" not in plan and plan.count("FileScan") == 1
    assert "Generate" in plan


def test_no_python_udf_anywhere(spark):
    import __spark_entry__ as E
    for key in ("league_standings", "event_analytics", "match_coverage", "silver_events"):
        plan = physical(E.queries()[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_bronze_lookback_prunes_partitions(spark, scratch):
    from touchline.operators.ingest import to_bronze
    from touchline.sources.demo import demo_records
    settings = L.demo_settings(root=scratch)
    b = to_bronze(demo_records(spark, SF_SMALL, "livescores"), "livescores", settings)
    write_table(b, settings.path("bronze", "livescores"))
    df = read_bronze(spark, settings.path("bronze", "livescores"), settings, days_back=7)
    plan = physical(df)
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters")[1]
    all_rows = read_bronze(spark, settings.path("bronze", "livescores"), settings,
                           days_back=None).count()
    assert 0 < df.count() < all_rows


def test_standings_filter_reaches_scan(spark):
    from pyspark.sql import functions as F
    df = L.league_standings(spark, SF_SMALL, S, ordered=False).filter(F.col("league_id") == 1)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {k: min(i for i, x in enumerate(lines) if x.lstrip(" :+-").startswith(k)) for k in ("Window",)}
    # the league filter sits below the window (on the team aggregate's input), not above it
    at = [i for i, x in enumerate(lines) if "Filter" in x and "league_id" in x and "= 1" in x]
    assert at and min(at) > depth["Window"]
