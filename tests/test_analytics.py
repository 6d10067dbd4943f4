"""Gold operators: results, ranking ties, invariants, event summaries."""

from pyspark.sql import functions as F

from touchline.operators import analytics as A
from touchline.plans import lineage as L
from tests.conftest import SF_SMALL

S = L.demo_settings()

LIVE = ("fixture_id bigint, fixture_name string, match_date date, home_team string, "
        "away_team string, home_score int, away_score int, total_goals int, league_id int, "
        "season_id int, is_finished boolean")


def results(spark, rows):
    df = spark.createDataFrame([(i, "", None, h, a, hs, as_, None, 1, 2024, True)
                                for i, (h, a, hs, as_) in enumerate(rows)], LIVE)
    return A.match_results(df, S)


def test_null_score_is_a_draw(spark):
    r = results(spark, [("A", "B", None, 1)]).first()
    assert r.result == "DRAW" and r.goal_difference is None


def test_ties_share_a_position_and_skip(spark):
    # A and B: one win each against C and D with the same score; C and D lose alike.
    res = results(spark, [("A", "C", 2, 0), ("B", "D", 2, 0), ("E", "F", 1, 1)])
    st = A.league_standings(A.team_performance(A.team_match_rows(res), S))
    pos = {r.team: r.position for r in st.collect()}
    assert pos["A"] == 1 and pos["B"] == 1
    assert pos["E"] == 3 and pos["F"] == 3
    assert pos["C"] == 5 and pos["D"] == 5


def test_standings_invariants(spark):
    st = L.league_standings(spark, SF_SMALL, S, ordered=False)
    rows = st.collect()
    assert rows
    for r in rows:
        assert r.points == 3 * r.total_wins + r.total_draws
        assert r.matches_played == r.total_wins + r.total_draws + r.total_losses
    per = st.groupBy("league_id", "season_id").agg(
        F.sum("total_wins").alias("w"), F.sum("total_losses").alias("l"),
        F.sum("total_draws").alias("d"), F.min("position").alias("first"),
        F.sum("goal_difference").alias("gd"),
        F.count_if(F.col("goal_difference").isNull()).alias("gd_null"))
    for r in per.collect():
        assert r.w == r.l and r.d % 2 == 0 and r.first == 1
        # every score counts once for and once against; a team whose only scores are
        # NULL has a NULL difference, which the sum skips
        assert r.gd_null > 0 or r.gd == 0


def test_team_rows_one_per_side(spark):
    res = results(spark, [("A", "B", 3, 1)])
    rows = {r.venue: r for r in A.team_match_rows(res).collect()}
    assert rows["home"].team == "A" and rows["home"].wins == 1 and rows["home"].goals_for == 3
    assert rows["away"].team == "B" and rows["away"].losses == 1 and rows["away"].goals_for == 1


def test_event_summary_players_multiset(spark):
    ev = spark.createDataFrame(
        [(1, 1, "GOAL", "P1", 10, None), (1, 2, "GOAL", "P1", 30, None),
         (1, 3, "GOAL", None, 50, None), (1, 4, "GOAL", "P2", 5, None)],
        "fixture_id bigint, event_id bigint, event_type string, player_name string, "
        "total_minutes int, result string")
    r = A.event_analytics(ev, S).withColumn("txt", A.players_text()).first()
    assert r.players_involved == ["P1", "P1", "P2"]  # names, one per event
    assert r.event_count == 4 and r.players_named == 3 and r.distinct_players == 2
    assert r.txt == "P1:2,P2:1"
    assert r.first_occurrence == 5 and r.last_occurrence == 50
    long = sorted((x.player_name, x.occurrences) for x in A.event_players(ev).collect())
    assert long == [("P1", 2), ("P2", 1)]


def test_goal_and_card_lists(spark):
    ev = spark.createDataFrame(
        [(1, 1, "OWN_GOAL", "P", 1, None), (1, 2, "PENALTY", "P", 2, "1-0"),
         (1, 3, "GOAL", "P", 3, None), (1, 4, "RED_CARD", "Q", 4, None),
         (1, 5, "SUBSTITUTION", "R", 5, None)],
        "fixture_id bigint, event_id bigint, event_type string, player_name string, "
        "total_minutes int, result string")
    goals = {r.event_id: r.scorer_type for r in A.goal_analytics(ev, S).collect()}
    assert goals == {1: "OWN_GOAL", 2: "PENALTY", 3: "REGULAR"}
    assert [r.event_id for r in A.card_analytics(ev, S).collect()] == [4]


def test_parity_switch_counts_every_poll(spark):
    """With the snapshot reduction off (the reference's behaviour), every live poll is a
    dashboard row, including earlier polls of games that have finished since."""
    parity = L.demo_settings(latest_snapshot=False)
    live_polls = L.silver(spark, SF_SMALL, "livescores", parity).filter("is_live").count()
    off = A.live_dashboard(L.gold_live_scores(spark, SF_SMALL, parity), parity).count()
    on = A.live_dashboard(L.gold_live_scores(spark, SF_SMALL, S), S)
    assert off == live_polls
    assert on.count() == on.select("fixture_id").distinct().count() < off


def test_team_key_by_id_separates_namesakes(spark):
    live = spark.createDataFrame(
        [(1, "", None, "United", "City", 2, 0, 2, 1, 2024, True, 10, 20),
         (2, "", None, "United", "Rovers", 1, 0, 1, 1, 2024, True, 11, 30)],
        LIVE + ", home_team_id bigint, away_team_id bigint")
    by_name = A.team_performance(A.team_match_rows(A.match_results(live, S)), S)
    assert by_name.filter("team = 'United'").first().matches_played == 2
    by_id_settings = L.demo_settings(team_key="id")
    rows = A.team_match_rows(A.match_results(live, by_id_settings))
    perf = A.team_performance(rows, by_id_settings)
    united = sorted((r.team_id, r.matches_played) for r in perf.filter("team = 'United'").collect())
    assert united == [(10, 1), (11, 1)]
    st = A.league_standings(perf)
    assert "team_id" in st.columns and st.count() == 4
