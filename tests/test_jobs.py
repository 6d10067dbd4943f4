"""The three layer jobs, run from their command-line entry point."""

from touchline import jobs
from touchline.plans.workspace import land
from touchline.sources.tables import read_table
from tests.conftest import SF_SMALL


def test_bronze_silver_gold_jobs(spark, scratch):
    for t in ("fixtures", "livescores", "leagues", "events"):
        land(spark, SF_SMALL, t, scratch)
    jobs.main(["bronze", "--root", scratch, "--source", "files", "--once",
               "--ingest-clock", "record"])
    jobs.main(["silver", "--root", scratch, "--days-back", "-1"])
    jobs.main(["gold", "--root", scratch, "--days-back", "-1", "--as-of", "2024-02-01 00:00:00"])
    st = read_table(spark, f"{scratch}/gold/league_standings")
    assert st.count() > 0 and set(st.columns) >= {"league_id", "position", "year", "month", "day"}
    dl = read_table(spark, f"{scratch}/silver/dead_letters")
    assert dl.filter("data_type = 'livescores'").count() > 0


def test_gold_season_tables_ignore_the_recent_window(spark, scratch):
    """Standings read the whole history; match results only the recent window."""
    from touchline.plans import lineage as L
    from touchline.plans.gold import run_gold
    from touchline.plans.silver import run_silver
    for t in ("fixtures", "livescores", "leagues", "events"):
        land(spark, SF_SMALL, t, scratch)
    jobs.main(["bronze", "--root", scratch, "--source", "files", "--once",
               "--ingest-clock", "record"])
    full = L.demo_settings(root=scratch)
    run_silver(spark, full)
    windowed = L.demo_settings(root=scratch, silver_days_back=7)
    report = run_gold(spark, windowed)
    everything = run_gold(spark, L.demo_settings(root=scratch))
    assert report["league_standings"] == everything["league_standings"]
    assert report["team_performance"] == everything["team_performance"]
    assert 0 < report["match_results"] < everything["match_results"]
