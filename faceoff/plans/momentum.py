"""contest_momentum: per-contest momentum features for both sides (M20, first job).

cleaned contests -> long side table -> last-5 wins & form (strict date), streak
(row order, reset on no winner), venue win rate (row order) -> back to one row
per contest (one grouped pivot) -> head-to-head over the whole table -> flags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff.operators import clean, form, sides, timeline

# The columns of the original's table, in its order.
MOMENTUM_COLUMNS = [
    "id", "season", "date", "team1", "team2", "venue",
    "toss_winner", "toss_decision", "chose_to_bat", "team1_won_toss",
    "team1_last5_wins", "team2_last5_wins", "team1_form", "team2_form",
    "team1_h2h_wins", "team2_h2h_wins", "team1_h2h_winrate", "team2_h2h_winrate",
    "team1_streak", "team2_streak",
    "team1_venue_win_rate", "team2_venue_win_rate",
    "winner", "team1_won",
]


def clean_contests(contests: DataFrame) -> DataFrame:
    """Contest cleaning of the momentum job: season, drop 'no result', canonical names."""
    if "season" not in contests.columns:
        contests = contests.withColumn("season", F.year("date"))
    return clean.canonical_names(clean.drop_no_result(contests))


def side_features(cleaned: DataFrame) -> DataFrame:
    """Per-side momentum columns, pivoted back to one row per contest id.

    The three history features are independent branches over the same long
    table (chaining them would make each branch re-read the previous one twice);
    their outputs are stacked and pivoted in one grouped aggregate on ``id``.
    """
    lt = sides.side_long(cleaned).select("id", "side", "team", "date", "venue", "won", "outcome")
    by_team = timeline.with_cell(lt, "team", "date", "id")
    a = form.last_n_wins(by_team).select("id", "side", "last5_wins", "form")
    b = form.streak_before(by_team, non_win="reset").select("id", "side", "streak")
    c = form.venue_team_rate(lt).select("id", "side", "venue_win_rate")
    u = a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    return sides.to_sides(u, ["last5_wins", "form", "streak", "venue_win_rate"])


def contest_momentum(contests: DataFrame, cleaned: bool = False) -> DataFrame:
    c = contests if cleaned else clean_contests(contests)
    feats = side_features(c)
    out = form.h2h_total(c).join(feats, "id", "left")
    out = sides.contest_flags(out)
    return out.select(*[col for col in MOMENTUM_COLUMNS if col in out.columns])
