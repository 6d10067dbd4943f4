"""SQL views over Gold show the newest daily snapshot only."""

from pyspark.sql import functions as F

from touchline.functions.dates import with_date_parts
from touchline.plans import lineage as L
from touchline.plans.views import register_views
from touchline.sinks.tables import log_run, write_table
from touchline.sources.tables import read_table
from tests.conftest import SF_SMALL


def test_views_show_newest_snapshot(spark, scratch):
    path_settings = L.demo_settings(root=scratch)
    counts = {}
    for day in ("2024-02-01 06:00:00", "2024-02-02 06:00:00"):
        s = L.demo_settings(root=scratch, as_of=day)
        st = L.league_standings(spark, SF_SMALL, s, ordered=False)
        counts[day] = write_table(with_date_parts(st, "processed_at"),
                                  s.path("gold", "league_standings"))
        log_run(spark, s, "gold", {"league_standings": counts[day]})
    register_views(spark, path_settings, ("league_standings",))
    view = spark.sql("select * from league_standings")
    assert view.count() == counts["2024-02-02 06:00:00"]
    assert view.select(F.countDistinct("day")).first()[0] == 1
    assert view.select(F.max("day")).first()[0] == 2
    stored = read_table(spark, path_settings.path("gold", "league_standings")).count()
    assert stored == sum(counts.values())


def test_dashboard_without_live_matches_is_empty(spark, scratch):
    """A later run of the day, or of the next day, without rows empties the view."""
    from touchline.functions.clock import day_before, in_days
    def run(as_of, n):
        s = L.demo_settings(root=scratch, as_of=as_of)
        df = spark.range(n).selectExpr("id as fixture_id", f"timestamp'{as_of}' as processed_at")
        today = day_before(as_of, 0)
        rows = write_table(with_date_parts(df, "processed_at"), s.path("gold", "live_dashboard"),
                           owned=lambda v: in_days(v, today, today))
        log_run(spark, s, "gold", {"live_dashboard": rows})
        register_views(spark, s, ("live_dashboard",))
        return spark.table("live_dashboard").count()
    assert run("2024-02-01 10:00:00", 3) == 3
    assert run("2024-02-01 11:00:00", 0) == 0
    assert run("2024-02-01 12:00:00", 2) == 2
    assert run("2024-02-02 10:00:00", 0) == 0
