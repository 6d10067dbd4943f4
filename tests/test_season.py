"""Season tables from stored state: only changed days are read, and the result is that of a rebuild."""

from pyspark.sql import functions as F

from touchline.operators.refine import refine_once
from touchline.plans import lineage as L
from touchline.plans import season
from touchline.plans.gold import GOLD_SORT, LIVE_COLUMNS, run_gold
from touchline.plans.silver import run_silver
from touchline.sinks.snapshots import snapshot
from touchline.sinks.tables import write_table
from touchline.sources.tables import read_table
from tests.conftest import SF_SMALL


def store_bronze(spark, settings, where=None):
    for t in ("fixtures", "livescores", "events", "leagues"):
        df = L.bronze(spark, SF_SMALL, t, settings)
        write_table(df.where(where) if where else df, settings.path("bronze", t))


def table(spark, settings, name):
    df = read_table(spark, settings.path("gold", name))
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_state_equals_a_rebuild(spark, scratch, monkeypatch):
    monkeypatch.setattr(season, "upsert_newest", lambda *a, **kw: _upsert(*a, size=500, **kw))
    s, whole = L.demo_settings(root=f"{scratch}/a"), L.demo_settings(root=f"{scratch}/b")
    # The month arrives in three parts; polls of one game lie on both sides of the cuts.
    for cut in ("2024-01-08", "2024-01-20", "2024-03-01"):
        store_bronze(spark, s, f"kafka_timestamp < '{cut}'")
        run_silver(spark, s)
        run_gold(spark, s)
    store_bronze(spark, whole)
    run_silver(spark, whole)
    run_gold(spark, whole)
    for name in GOLD_SORT:
        assert table(spark, s, name) == table(spark, whole, name), name
    run_gold(spark, s, rebuild=True)
    for name in GOLD_SORT:
        assert table(spark, s, name) == table(spark, whole, name), name


def _upsert(*args, **kw):
    from touchline.sinks.upsert import upsert_newest
    return upsert_newest(*args, **kw)


def test_a_second_run_reads_new_days_only(spark, scratch):
    s = L.demo_settings(root=scratch, bronze_days_back=7)
    b = L.bronze(spark, SF_SMALL, "livescores", s)
    write_table(b.where("day <= 10"), s.path("bronze", "livescores"))
    run_silver(spark, L.demo_settings(root=scratch), types=("livescores",))
    season.refresh(spark, s, LIVE_COLUMNS)
    write_table(b.where("day between 11 and 12"), s.path("bronze", "livescores"))
    later = L.demo_settings(root=scratch, bronze_days_back=2, as_of="2024-01-13 00:00:00")
    run_silver(spark, later, types=("livescores",))
    _, fresh, whole = season.fresh_rows(spark, s, LIVE_COLUMNS)
    assert not whole
    read = {f.split("/day=")[1].split("/")[0] for f in fresh.inputFiles()}
    assert read == {"11", "12"}
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    season.refresh(spark, s, LIVE_COLUMNS)
    # nothing new: no new version, nothing read
    version = snapshot(spark, season.state_path(s, "newest_live")).version
    assert season.fresh_rows(spark, s, LIVE_COLUMNS)[1] is None
    season.refresh(spark, s, LIVE_COLUMNS)
    assert snapshot(spark, season.state_path(s, "newest_live")).version == version


def test_sums_are_rebuilt_after_a_lost_run(spark, scratch):
    """A run that dies between its two commits leaves sums of an older version: they are built again."""
    s = L.demo_settings(root=scratch)
    b = L.bronze(spark, SF_SMALL, "livescores", s)
    write_table(b.where("day <= 10"), s.path("bronze", "livescores"))
    run_silver(spark, s, types=("livescores",))
    season.refresh(spark, s, LIVE_COLUMNS)
    write_table(b, s.path("bronze", "livescores"))
    run_silver(spark, s, types=("livescores",))
    silver, fresh, _ = season.fresh_rows(spark, s, LIVE_COLUMNS)
    season.upsert_newest(spark, season.state_path(s, "newest_live"), fresh, "fixture_id",
                         tags={"silver": silver.parts})
    season.refresh(spark, s, LIVE_COLUMNS)
    sums = read_table(spark, season.state_path(s, "team_sums"))
    got = season.performance(sums, s).drop("processed_at")
    want = L.team_performance(spark, SF_SMALL, s).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_scores_that_vanish_and_teams_that_stay_null(spark, scratch):
    """Corrections take back what a fixture counted before; sums without a known value are null again."""
    s = L.demo_settings(root=scratch)
    row = dict(fixture_id=1, fixture_name="A vs B", match_date=None, home_team="A", away_team="B", home_team_id=1,
               away_team_id=2, home_score=2, away_score=1, total_goals=3, events_count=0, league_id=1, season_id=1,
               starting_at=None, is_live=False, is_finished=True, kafka_partition=0)
    def poll(offset, **change):
        r = row | change | {"kafka_offset": offset}
        return r
    kinds = {f.name: f.dataType for f in L.silver(spark, SF_SMALL, "livescores", s).schema}
    from pyspark.sql.types import StructField, StructType
    def frame(*rows):
        ts = "timestamp'2024-01-01 00:00:00'"
        cols = [c for c in LIVE_COLUMNS if c not in ("silver_processed_at", "kafka_timestamp")]
        schema = StructType([StructField(c, kinds[c]) for c in cols])
        df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)
        return (df.withColumns({"silver_processed_at": F.expr(ts), "kafka_timestamp": F.expr(ts)})
                .withColumns({"year": F.lit(2024), "month": F.lit(1), "day": F.col("kafka_offset").cast("int")}))
    path = s.path("silver", "live_scores")
    def totals():
        season.refresh(spark, s, LIVE_COLUMNS)
        sums = read_table(spark, season.state_path(s, "team_sums"))
        return {r.team: (r.total_wins, r.total_goals_for, r.matches_played, r.points)
                for r in season.performance(sums, s).collect()}
    write_table(frame(poll(1)), path)
    assert totals() == {"A": (1, 2, 1, 3), "B": (0, 1, 1, 0)}
    write_table(frame(poll(2, home_score=None, away_score=1, total_goals=None)), path)
    assert totals() == {"A": (0, None, 1, 1), "B": (0, 1, 1, 1)}
    write_table(frame(poll(3, is_finished=False, is_live=True)), path)  # taken back
    assert totals() == {}
    write_table(frame(poll(4, home_team="C"), poll(4, fixture_id=70_000, league_id=2)), path)
    assert totals() == {"C": (1, 2, 1, 3), "B": (0, 1, 1, 0), "A": (1, 2, 1, 3)} | {"B": (0, 1, 1, 0)}
    # a Silver day that vanishes makes the state start over
    write_table(frame(poll(2)), path, owned=lambda v: True)
    assert totals() == {"A": (1, 2, 1, 3), "B": (0, 1, 1, 0)}


def test_silver_and_dead_letters_share_one_parse(spark):
    from touchline.operators.quality import dead_letters
    from touchline.operators.refine import LETTERS, REFINERS, ROWS
    s = L.demo_settings()
    for t in ("livescores", "events", "fixtures", "leagues"):
        bronze = L.bronze(spark, SF_SMALL, t, s)
        both = refine_once(bronze, t, s)
        assert both._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
        for target, want in ((ROWS, REFINERS[t](bronze, s)), (LETTERS, dead_letters(bronze, t, s))):
            got = both.where(F.col("target") == target).select(*want.columns)
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_gold_over_streamed_silver_reads_new_files_only(spark, scratch, monkeypatch):
    """Gold with the streamed layer equals Gold on batch tables, run after run."""
    from touchline.streaming import dashboard as D
    from touchline.streaming.incremental import run_silver_incremental
    read = []
    real = D.run_dashboard

    def spied(*args):
        progress = real(*args)
        read.append(progress.get("numInputRows", 0))
        return progress

    monkeypatch.setattr(D, "run_dashboard", spied)
    s = L.demo_settings(root=f"{scratch}/a", silver_layer="silver_stream")
    whole = L.demo_settings(root=f"{scratch}/b")
    for part in (0, 1):
        for t, table_name in (("livescores", "live_scores"), ("events", "events")):
            (L.bronze(spark, SF_SMALL, t, s).where(F.col("kafka_offset") % 2 == part).write.mode("append")
             .partitionBy("year", "month", "day").parquet(s.path("bronze", t)))
            run_silver_incremental(spark, s, t, table_name)
        run_gold(spark, s)
    store_bronze(spark, whole)
    run_silver(spark, whole)
    run_gold(spark, whole)
    for name in GOLD_SORT:
        assert table(spark, s, name) == table(spark, whole, name), name
    rows = read_table(spark, s.path("silver_stream", "live_scores")).count()
    assert read[1] < rows


def test_failures_are_counted_by_the_run(spark, scratch):
    from touchline.operators.quality import failure_rate
    from touchline.sinks.tables import newest_quality
    s = L.demo_settings(root=scratch)
    store_bronze(spark, s)
    for keep in (False, True):
        run_silver(spark, L.demo_settings(root=scratch, keep_bad_rows=keep))
        got = {r.data_type: r for r in newest_quality(spark, s).collect()}
        for t in ("livescores", "events"):
            want = failure_rate(L.bronze(spark, SF_SMALL, t, s), t).first()
            assert (got[t].messages, got[t].dead_letters, got[t].partial) == (
                want.messages, want.dead_letters, want.partial)
            assert abs(got[t].failure_rate - want.failure_rate) < 1e-12
