"""contest_form: innings scores, last-5 team form and score labels (M20, second job).

contests (renamed, winner required) ⟕ innings pivot -> long side table ⟕
team-match stats on (contest, team) -> last-5 metrics strictly before the
date -> back to one row per contest -> winning/losing score -> flags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.operators import aggregates, clean, form, sides

FORM_METRICS = ["win_rate_last_5", "avg_margin_last_5", "avg_runs_scored_last_5",
                "avg_wickets_taken_last_5", "avg_economy_rate_last_5"]

# The columns of the original's table, in its order.
FORM_COLUMNS = [
    "id", "date", "team1", "team2", "venue", "toss_winner", "toss_decision", "winner",
    "inning1_score", "inning2_score", "winning_score", "losing_score",
    "team1_win_rate_last_5", "team1_avg_margin_last_5",
    "team2_win_rate_last_5", "team2_avg_margin_last_5",
    "team1_avg_runs_scored_last_5", "team1_avg_wickets_taken_last_5", "team1_avg_economy_rate_last_5",
    "team2_avg_runs_scored_last_5", "team2_avg_wickets_taken_last_5", "team2_avg_economy_rate_last_5",
    "toss_winner_is_team1", "team1_bat_first", "team1_toss_bat_first", "team2_toss_bat_first",
    "team1_won",
]


def clean_form_contests(contests: DataFrame) -> DataFrame:
    c = clean.canonical_names(contests)
    return clean.require_columns(c, ["winner"])


def contest_scores(contests: DataFrame, plays: DataFrame) -> DataFrame:
    """Contests ⟕ innings pivot, missing scores 0."""
    ip = aggregates.innings_pivot(plays)
    return contests.join(ip, "id", "left").fillna({"inning1_score": 0, "inning2_score": 0})


def side_stats(contests: DataFrame, plays: DataFrame) -> DataFrame:
    """Long side table ⟕ team-match stats on (contest, team): one row per side."""
    lt = sides.side_long(contests).select("id", "side", "team", "date", "won", "signed_margin")
    tms = aggregates.team_match_stats(clean.canonical_names(plays)).select(
        F.col("match_id").alias("id"), F.col("team").alias("_t"),
        "runs_scored", "wickets_taken", "economy_rate")
    j = lt.join(tms, (lt.id == tms.id) & (lt.team == tms._t), "left").drop(tms.id).drop("_t")
    return j


def recent_features(contests: DataFrame, plays: DataFrame, n: int = schemas.LAST_N) -> DataFrame:
    """Last-n metrics per side, pivoted to one row per contest.

    The last-n scan reads the side table twice (day tails, join back); the side
    table is written once to the checkpoint folder so the play aggregation
    behind it is not run twice.
    """
    from faceoff.ml.prep import materialize
    lt = form.recent_form(materialize(side_stats(contests, plays)), n)
    return sides.to_sides(lt, FORM_METRICS)


def contest_form(contests: DataFrame, plays: DataFrame, cleaned: bool = False,
                 score_mode: str = "reference") -> DataFrame:
    c = contests if cleaned else clean_form_contests(contests)
    plays = clean.canonical_names(plays)
    scored = contest_scores(c, plays)
    feats = recent_features(c, plays)
    out = scored.join(feats, "id", "left")
    out = sides.winning_losing_score(out, mode=score_mode)
    out = sides.contest_flags(out)
    out = out.dropna(subset=["winning_score", "losing_score"])
    return out.select(*FORM_COLUMNS)
