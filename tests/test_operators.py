"""Hand-made fixtures for the pandas-vs-Spark traps and the original quirks."""

import datetime as dt

from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.operators import aggregates, clean, form, sides
from faceoff.plans import form as form_plan
from faceoff.plans import momentum

D = dt.date


def contests(spark, rows):
    return spark.createDataFrame(rows, schemas.CONTEST)


def test_drop_no_result_keeps_null_result(spark):
    c = contests(spark, [(1, 2020, D(2020, 1, 1), "A", "B", "V", "A", "bat", "A", None, 1.0),
                         (2, 2020, D(2020, 1, 2), "A", "B", "V", "A", "bat", None, "no result", None)])
    assert [r.id for r in clean.drop_no_result(c).collect()] == [1]


def test_canonical_names_all_team_columns(spark):
    c = contests(spark, [(1, 2020, D(2020, 1, 1), "Delhi Daredevils", "Kings XI Punjab", "V", "Delhi Daredevils",
                          "bat", "Kings XI Punjab", "runs", 3.0)])
    r = clean.canonical_names(c).first()
    assert (r.team1, r.team2, r.toss_winner, r.winner) == ("Delhi Capitals", "Punjab Kings", "Delhi Capitals",
                                                            "Punjab Kings")


def test_winning_losing_truth_table(spark):
    rows = [(1, "A", "B", "A", "wickets", 100, 90), (2, "A", "B", "A", "runs", 100, 90),
            (3, "A", "B", "B", "wickets", 100, 90), (4, "A", "B", "B", "runs", 100, 90),
            (5, "A", "B", "C", "tie", 80, 95), (6, "A", "B", None, None, 80, 95)]
    df = spark.createDataFrame(rows, "id long, team1 string, team2 string, winner string, result string, "
                                     "inning1_score long, inning2_score long")
    got = {r.id: (r.winning_score, r.losing_score) for r in sides.winning_losing_score(df).collect()}
    assert got == {1: (90, 100), 2: (100, 90), 3: (100, 90), 4: (90, 100), 5: (95, 80), 6: (None, None)}
    bo = {r.id: (r.winning_score, r.losing_score) for r in sides.winning_losing_score(df, "batting_order").collect()}
    assert bo[1] == (100, 90) and bo[3] == (90, 100)


def test_flags_null_safe(spark):
    c = contests(spark, [(1, 2020, D(2020, 1, 1), "A", "B", "V", None, None, None, None, None),
                         (2, 2020, D(2020, 1, 1), "A", "B", "V", "B", "field", "A", "runs", 5.0)])
    f = {r.id: r for r in sides.contest_flags(c).collect()}
    assert (f[1].team1_won, f[1].chose_to_bat, f[1].team1_won_toss, f[1].team2_toss_bat_first) == (0, 0, 0, 0)
    assert (f[2].team1_won, f[2].chose_to_bat, f[2].team1_won_toss) == (1, 1, 0)


def plays(spark, rows, extras=True):
    cols = ("match_id long, inning int, ball int, batter long, bowler long, batting_team string, "
            "bowling_team string, batsman_runs int, total_runs int, is_wicket int, player_dismissed long")
    if extras:
        cols += ", wide_runs int, noball_runs int"
    return spark.createDataFrame(rows, cols)


def test_team_match_stats_no_legal_balls_and_missing_extras(spark):
    p = plays(spark, [(1, 1, 1, 10, 5, "A", "B", 4, 5, 0, None, 1, 0),
                      (1, 2, 2, 11, None, "B", "A", 1, 1, 1, 11, 0, 0)])
    got = {(r.match_id, r.team): r for r in aggregates.team_match_stats(p).collect()}
    b = got[(1, "B")]  # B bowled one wide only: no legal balls -> NULL economy
    assert (b.runs_conceded, b.legal_balls_bowled, b.economy_rate, b.wickets_taken) == (5, 0, None, 0)
    a = got[(1, "A")]  # the dismissal had no bowler: not a wicket
    assert (a.runs_scored, a.wickets_taken, a.legal_balls_bowled) == (5, 0, 1)
    p2 = plays(spark, [(1, 1, 1, 10, 5, "A", "B", 4, 5, 0, None)], extras=False)
    r = aggregates.team_match_stats(p2).filter(F.col("team") == "B").first()
    assert (r.legal_balls_bowled, r.economy_rate) == (1, 30.0)


def test_recent_form_defaults_and_same_day(spark):
    # A plays twice on day 2: neither contest of that day sees the other
    c = contests(spark, [(1, 2020, D(2020, 1, 1), "A", "B", "V", "A", "bat", "A", "runs", 10.0),
                         (2, 2020, D(2020, 1, 2), "A", "C", "V", "A", "bat", "C", "wickets", 3.0),
                         (3, 2020, D(2020, 1, 2), "A", "B", "V", "A", "bat", "A", "runs", 7.0)])
    p = plays(spark, [(1, 1, 1, 10, 5, "A", "B", 4, 4, 0, None, 0, 0),
                      (1, 2, 2, 11, 6, "B", "A", 1, 1, 0, None, 0, 0)])
    st = form_plan.side_stats(c, p)
    r = {(x.id, x.team): x for x in form.recent_form(st).collect()}
    first = r[(1, "A")]
    assert (first.win_rate_last_5, first.avg_margin_last_5, first.avg_runs_scored_last_5,
            first.avg_economy_rate_last_5) == (0.0, 0.0, 0.0, 10.0)
    for cid in (2, 3):
        x = r[(cid, "A")]
        assert (x.win_rate_last_5, x.avg_margin_last_5, x.avg_runs_scored_last_5) == (1.0, 10.0, 4.0)
    assert r[(2, "C")].avg_economy_rate_last_5 == 10.0


def test_momentum_streak_venue_h2h(spark):
    c = contests(spark, [(1, 2020, D(2020, 1, 1), "A", "B", "V", "A", "bat", "A", "runs", 1.0),
                         (2, 2020, D(2020, 1, 1), "A", "B", "V", "A", "bat", "A", "runs", 1.0),
                         (3, 2020, D(2020, 1, 3), "B", "A", "V", "A", "bat", None, "tie", None),
                         (4, 2020, D(2020, 1, 4), "A", "B", "W", "A", "bat", "B", "runs", 1.0)])
    m = {r.id: r for r in momentum.contest_momentum(c).collect()}
    assert (m[1].team1_streak, m[2].team1_streak, m[3].team2_streak, m[4].team1_streak) == (0, 1, 2, 0)
    assert (m[1].team1_last5_wins, m[2].team1_last5_wins, m[3].team2_last5_wins) == (0, 0, 2)
    assert (m[1].team1_venue_win_rate, m[2].team1_venue_win_rate, m[3].team2_venue_win_rate) == (0.5, 1.0, 1.0)
    assert m[4].team1_venue_win_rate == 0.5
    assert (m[1].team1_h2h_wins, m[1].team2_h2h_wins, m[1].team1_h2h_winrate) == (2, 1, 0.5)
    assert abs(m[4].team1_form - (1 + 2) / 15) < 1e-12  # 3 earlier: won, won, tie -> weights 1, 2, 3


def test_team_career_counts(spark):
    c = contests(spark, [(1, 2020, D(2020, 1, 1), "A", "B", "V", "A", "bat", "A", "runs", 1.0),
                         (2, 2020, D(2020, 1, 2), "B", "A", "V", "B", "bat", "A", "runs", 1.0),
                         (3, 2020, D(2020, 1, 3), "C", "A", "V", "C", "bat", None, None, None)])
    r = {x.team: x for x in aggregates.team_career(c).collect()}
    assert (r["A"].total_matches, r["A"].total_wins, r["A"].home_win_rate, r["A"].away_win_rate) == (3, 2, 1.0, 0.5)
    assert r["C"].win_rate == 0.0 and r["B"].toss_win_rate == 0.5


def test_legal_balls_and_innings_options(spark):
    rows = [(1, 1, "A", "B", 1, "x", "p", 4, 4, 0, None, 0, 0), (1, 1, "A", "B", 2, "x", "p", 0, 1, 0, None, 1, 0),
            (1, 1, "A", "B", 3, "x", "p", 6, 7, 0, None, 0, 1), (1, 3, "A", "B", 1, "x", "p", 1, 1, 1, "x", 0, 0),
            (1, 2, "B", "A", 1, "y", "q", 0, 1, 0, None, 1, 0)]
    p = spark.createDataFrame(rows, "match_id long, inning int, batting_team string, bowling_team string, ball int, batter string, "
                                    "bowler string, batsman_runs int, total_runs int, is_wicket int, player_dismissed string, "
                                    "wide_runs int, noball_runs int")
    faced = lambda **o: {r.batter: (r.total_runs, r.balls_faced, r.strike_rate) for r in aggregates.batter_career(p, **o).collect()}
    assert faced() == {"x": (11, 4, 275.0), "y": (0, 1, 0.0)}
    assert faced(legal_only=True) == {"x": (11, 2, 550.0), "y": (0, 0, None)}
    bowled = {r.bowler: (r.runs_conceded, r.economy) for r in aggregates.bowler_career(p, legal_only=True).collect()}
    assert bowled == {"p": (13, 39.0), "q": (1, None)}
    plain = aggregates.bowler_career(p.drop("wide_runs", "noball_runs"), legal_only=True).collect()
    assert {r.bowler: r.overs_bowled * 6 for r in plain} == {"p": 4.0, "q": 1.0}  # without the columns every ball is legal
    stats = lambda **o: {r.team: (r.runs_scored, r.wickets_taken, r.legal_balls_bowled)
                         for r in aggregates.team_match_stats(p, **o).collect()}
    assert stats() == {"A": (13, 0, 0), "B": (1, 1, 2)}
    assert stats(innings=[1, 2]) == {"A": (12, 0, 0), "B": (1, 0, 1)}
