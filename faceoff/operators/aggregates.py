"""Grouped statistics over contests and plays.

Plays are always reduced to the join key's grain before they meet the contest
table, so the big side is shuffled as partial aggregates, not as raw plays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.functions.columns import eq_flag, safe_ratio
from faceoff.functions.joins import by_key
from faceoff.operators import timeline


def team_career(contests: DataFrame) -> DataFrame:
    """A1: per team: matches, wins, win rate, toss win rate, home (side 1) and away (side 2) win rates.

    Wins and toss wins count every contest whose winner / toss winner is the team;
    rates are 0 when the denominator is 0. One aggregate over four roles per contest.
    """
    t1, t2, w, tw = F.col("team1"), F.col("team2"), F.col("winner"), F.col("toss_winner")

    def role(team, played, home, away, home_win, away_win, win, toss):
        return F.struct(team.alias("team"), F.lit(played).alias("played") if isinstance(played, int) else played.alias("played"),
                        F.lit(home).alias("home"), F.lit(away).alias("away"),
                        home_win.alias("home_win"), away_win.alias("away_win"),
                        F.lit(win).alias("win"), F.lit(toss).alias("toss"))

    zero = F.lit(0)
    roles = F.array(
        role(t1, 1, 1, 0, eq_flag(w, t1), zero, 0, 0),
        role(t2, F.when(t2.eqNullSafe(t1), 0).otherwise(1), 0, 1, zero, eq_flag(w, t2), 0, 0),
        role(w, 0, 0, 0, zero, zero, 1, 0),
        role(tw, 0, 0, 0, zero, zero, 0, 1),
    )
    g = (contests.select(F.explode(roles).alias("r")).select("r.*")
         .filter(F.col("team").isNotNull())
         .groupBy("team").agg(
             F.sum("played").cast("long").alias("total_matches"),
             F.sum("win").cast("long").alias("total_wins"),
             F.sum("toss").cast("long").alias("_toss"),
             F.sum("home").cast("long").alias("_home"),
             F.sum("away").cast("long").alias("_away"),
             F.sum("home_win").cast("long").alias("_hw"),
             F.sum("away_win").cast("long").alias("_aw"),
         ))
    g = g.filter((F.col("_home") + F.col("_away")) > 0)
    return g.select(
        "team", "total_matches", "total_wins",
        safe_ratio("total_wins", "total_matches", 0).alias("win_rate"),
        safe_ratio("_toss", "total_matches", 0).alias("toss_win_rate"),
        safe_ratio("_hw", "_home", 0).alias("home_win_rate"),
        safe_ratio("_aw", "_away", 0).alias("away_win_rate"),
    )


def first_innings_by_match(plays: DataFrame) -> DataFrame:
    return (plays.filter(F.col("inning") == 1).groupBy("match_id")
            .agg(F.sum("total_runs").alias("first_innings")))


def venue_stats(contests: DataFrame, plays: DataFrame) -> DataFrame:
    """Per venue: contests, most frequent winner, toss impact, mean first-innings total.

    Most frequent winner: highest count, ties to the alphabetically first name;
    NULL when no contest at the venue has a winner. Mean first-innings total is
    over the venue's contests that have first-innings plays, 0 when none.
    """
    c = contests.filter(F.col("venue").isNotNull())
    base = c.groupBy("venue").agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.count_if(F.col("toss_winner") == F.col("winner")).alias("_toss_eq"),
    )
    wins = (c.filter(F.col("winner").isNotNull()).groupBy("venue", "winner").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("venue").agg(F.min_by("winner", F.struct((-F.col("_n")).alias("a"), F.col("winner").alias("b")))
                                  .alias("most_successful_team")))
    fi = first_innings_by_match(plays)
    fi = (fi.join(by_key(c.select("id", "venue")), fi.match_id == c.id)
          .groupBy("venue").agg(F.avg("first_innings").alias("_afi")))
    return (base.join(wins, "venue", "left").join(fi, "venue", "left")
            .select("venue", "total_matches", "most_successful_team",
                    safe_ratio("_toss_eq", "total_matches", 0).alias("toss_win_impact"),
                    F.coalesce(F.col("_afi"), F.lit(0.0)).alias("avg_first_innings_score")))


def batter_career(plays: DataFrame, legal_only: bool = False) -> DataFrame:
    """A3: runs, balls, fours, sixes, strike rate per batter.

    Every play counts as a ball, as in the original; with ``legal_only`` those that are wides or no-balls
    don't (their runs still count). The strike rate of a batter without a ball is NULL.
    """
    r = F.col("batsman_runs")
    return (plays.filter(F.col("batter").isNotNull()).groupBy("batter").agg(
        F.sum(r).cast("long").alias("total_runs"),
        _balls(plays, legal_only).alias("balls_faced"),
        F.count_if(r == 4).alias("fours"),
        F.count_if(r == 6).alias("sixes"),
    ).withColumn("strike_rate", safe_ratio("total_runs", "balls_faced") * 100))


def bowler_career(plays: DataFrame, legal_only: bool = False) -> DataFrame:
    """A4: overs (= plays / 6), wickets, runs conceded, economy per bowler.

    With ``legal_only`` wides and no-balls are no part of an over (their runs still count); the economy of a
    bowler without a legal ball is NULL.
    """
    return (plays.filter(F.col("bowler").isNotNull()).groupBy("bowler").agg(
        (_balls(plays, legal_only) / 6.0).alias("overs_bowled"),
        F.sum("is_wicket").cast("long").alias("wickets"),
        F.sum("total_runs").cast("long").alias("runs_conceded"),
    ).withColumn("economy", safe_ratio("runs_conceded", "overs_bowled")))


def _balls(plays: DataFrame, legal_only: bool):
    return F.count(F.when(~_extra_flag(plays), F.col("match_id"))) if legal_only else F.count("match_id")


def player_match(contests: DataFrame, plays: DataFrame, legal_only: bool = False) -> DataFrame:
    """Runs and balls (``legal_only`` as in :func:`batter_career`) per (contest, batter), for contests
    kept in ``contests``.

    Plays are aggregated to (match, batter) first; the semi join then only
    moves that much smaller table.
    """
    pm = (plays.filter(F.col("batter").isNotNull()).groupBy("match_id", "batter")
          .agg(F.sum("batsman_runs").cast("long").alias("runs_scored"), _balls(plays, legal_only).alias("balls_faced")))
    return pm.join(by_key(contests.select(F.col("id").alias("match_id"))), "match_id", "left_semi")


def innings_pivot(plays: DataFrame) -> DataFrame:
    """Total runs of innings 1 and 2 per contest as two columns, 0 when missing."""
    i = F.col("inning")
    main = plays.filter(i.isin(1, 2))
    return main.groupBy(F.col("match_id").alias("id")).agg(
        F.coalesce(F.sum(F.when(i == 1, F.col("total_runs"))), F.lit(0)).cast("long").alias("inning1_score"),
        F.coalesce(F.sum(F.when(i == 2, F.col("total_runs"))), F.lit(0)).cast("long").alias("inning2_score"),
    )


def _extra_flag(plays: DataFrame):
    conds = [F.col(c) > 0 for c in ("wide_runs", "noball_runs") if c in plays.columns]
    if not conds:
        return F.lit(False)
    e = conds[0]
    for c in conds[1:]:
        e = e | c
    return F.coalesce(e, F.lit(False))


def bowling_match(plays: DataFrame) -> DataFrame:
    """Per (contest, bowling team): runs conceded, balls, extra balls, legal balls, economy.

    Extra balls are wides or no-balls (0 when those columns are absent);
    economy = 6·runs / legal balls, NULL when there are no legal balls.
    """
    g = (plays.filter(F.col("bowling_team").isNotNull())
         .groupBy("match_id", F.col("bowling_team").alias("team")).agg(
             F.sum("total_runs").cast("long").alias("runs_conceded"),
             F.count("ball").alias("balls_bowled"),
             F.count_if(_extra_flag(plays)).alias("extra_balls")))
    g = g.withColumn("legal_balls_bowled", F.col("balls_bowled") - F.col("extra_balls"))
    return g.withColumn("economy_rate", safe_ratio(F.col("runs_conceded") * 6, "legal_balls_bowled"))


def team_match_stats(plays: DataFrame, innings: list[int] | None = None) -> DataFrame:
    """Per (contest, team): runs scored, wickets taken, runs conceded, legal balls, economy.

    The batting and bowling views of each play go through one aggregate (a play
    counts once for its batting team and once for its bowling team) instead of
    three aggregates and two full outer joins. Wickets = dismissals on plays
    with a bowler. Missing parts are 0, except economy (NULL). ``innings`` keeps the plays of these innings
    only (``[1, 2]`` leaves super overs out, as the innings scores do); by default all count, as in the original.
    """
    if innings is not None:
        plays = plays.filter(F.col("inning").isin(*innings))
    extra = _extra_flag(plays)
    bat = F.struct(F.col("match_id"), F.col("batting_team").alias("team"), F.lit(True).alias("is_bat"),
                   F.col("total_runs").alias("runs"), F.lit(None).cast("boolean").alias("wk"),
                   F.lit(None).cast("int").alias("ball"), F.lit(False).alias("extra"))
    bowl = F.struct(F.col("match_id"), F.col("bowling_team").alias("team"), F.lit(False).alias("is_bat"),
                    F.col("total_runs").alias("runs"),
                    (F.col("bowler").isNotNull() & F.col("player_dismissed").isNotNull()).alias("wk"),
                    F.col("ball").cast("int").alias("ball"), extra.alias("extra"))
    u = plays.select(F.explode(F.array(bat, bowl)).alias("u")).select("u.*").filter(F.col("team").isNotNull())
    b = F.col("is_bat")
    g = u.groupBy("match_id", "team").agg(
        F.coalesce(F.sum(F.when(b, F.col("runs"))), F.lit(0)).cast("long").alias("runs_scored"),
        F.count_if(~b & F.col("wk")).alias("wickets_taken"),
        F.coalesce(F.sum(F.when(~b, F.col("runs"))), F.lit(0)).cast("long").alias("runs_conceded"),
        (F.count(F.when(~b, F.col("ball"))) - F.count_if(~b & F.col("extra"))).alias("legal_balls_bowled"),
    )
    return g.withColumn("economy_rate", safe_ratio(F.col("runs_conceded") * 6, "legal_balls_bowled"))


def batting_average(plays: DataFrame) -> DataFrame:
    """Runs / distinct contests batted, per batter (two-level aggregate, no COUNT DISTINCT)."""
    per = (plays.filter(F.col("batter").isNotNull()).groupBy("batter", "match_id")
           .agg(F.sum("batsman_runs").alias("_r")))
    return per.groupBy("batter").agg(
        F.coalesce(safe_ratio(F.sum("_r"), F.count(F.lit(1))), F.lit(0.0)).alias("batting_average"))


def contests_of_players(contests: DataFrame, plays: DataFrame) -> DataFrame:
    """Every (batter, contest) the batter appears in, with the contest's date and winner."""
    bm = plays.filter(F.col("batter").isNotNull()).select("batter", "match_id").distinct()
    return (bm.join(by_key(contests.select("id", "date", "winner")), bm.match_id == contests.id)
            .select("batter", "id", "date", "winner"))


def team_last_n_runs(long_df: DataFrame, plays: DataFrame, n: int = schemas.LAST_N, side: str = "both") -> DataFrame:
    """Mean runs per contest over each team's latest ``n`` contests.

    ``side='both'`` adds both teams' batter runs of those contests (as the
    original helper did); ``'own'`` only the team's own batting.
    """
    latest = timeline.latest_n(long_df.select("team", "id", "date"), "team",
                               [F.col("date").desc(), F.col("id").desc()], n)
    # only plays of those contests are summed: at most n contests a team
    wanted = latest.select(F.col("id").alias("match_id")).distinct()
    p = plays.filter(F.col("batter").isNotNull()).join(wanted, "match_id", "left_semi")
    if side == "both":
        runs = p.groupBy("match_id").agg(F.sum("batsman_runs").alias("_r"))
        j = latest.join(runs, latest.id == runs.match_id, "left")
    elif side == "own":
        runs = p.groupBy("match_id", F.col("batting_team").alias("_bt")).agg(F.sum("batsman_runs").alias("_r"))
        j = latest.join(runs, (latest.id == runs.match_id) & (latest.team == runs._bt), "left")
    else:
        raise ValueError(side)
    return j.groupBy("team").agg(
        (F.coalesce(F.sum("_r"), F.lit(0)) / F.count(F.lit(1))).alias("avg_runs_last_n"))


def player_recent_form(plays: DataFrame, n: int = schemas.LAST_N) -> DataFrame:
    """Each batter's runs over their latest ``n`` plays (by contest id), divided by ``n``."""
    order = [F.col("match_id").desc(), F.col("inning").desc(), F.col("ball").desc(), F.col("batsman_runs").desc()]
    top = timeline.latest_n(plays.filter(F.col("batter").isNotNull())
                            .select("batter", "match_id", "inning", "ball", "batsman_runs"), "batter", order, n)
    return top.groupBy("batter").agg((F.sum("batsman_runs") / F.lit(float(n))).alias("recent_form"))


def plays_with_venue(contests: DataFrame, plays: DataFrame) -> DataFrame:
    """Plays joined to their contest's venue (inner)."""
    return plays.join(by_key(contests.select(F.col("id").alias("match_id"), "venue")), "match_id")
