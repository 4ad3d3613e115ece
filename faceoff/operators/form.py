"""Time-ordered per-entity features.

All history features run on the long side table (:func:`sides.side_long`) and use
:mod:`faceoff.operators.timeline`, so no window over rows is ever partitioned by a team, or a team and day, alone. That
module reads its input more than once: what comes out of joins and aggregates is written first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.functions.columns import eq_flag, safe_ratio
from faceoff.functions.joins import by_key
from faceoff.operators import clean, sides, timeline
from faceoff.scratch import materialize


def _sum_field(arr: Column, field: str, dtype: str = "long") -> Column:
    return F.aggregate(arr, F.lit(0).cast(dtype), lambda acc, x: acc + F.coalesce(x[field].cast(dtype), F.lit(0).cast(dtype)))


def _count_field(arr: Column, field: str) -> Column:
    return F.size(F.filter(arr, lambda x: x[field].isNotNull()))


def _weighted_recency(arr: Column, field: str, divisor: float) -> Column:
    """Σ i·x_i / divisor with i = 1 for the oldest element of ``arr``."""
    w = F.transform(arr, lambda x, i: x[field].cast("double") * (i + 1))
    return F.aggregate(w, F.lit(0.0), lambda acc, y: acc + y) / F.lit(divisor)


def last_n_wins(long_df: DataFrame, n: int = schemas.LAST_N, strict_time: bool = True) -> DataFrame:
    """Wins and recency-weighted form over the team's last ``n`` earlier contests.

    Adds ``last5_wins`` (count of wins) and ``form`` (Σ i·won/15, i = 1 oldest).
    Earlier = strictly earlier date (``strict_time``) or earlier in (date, id) order.
    """
    values = {"last5_wins": _sum_field(F.col("_prior"), "won"),
              "form": _weighted_recency(F.col("_prior"), "won", schemas.FORM_WEIGHT_DIVISOR)}
    return timeline.prior_rows(long_df, "team", "date", "id", n, {"won": F.col("won")}, strict_time=strict_time, values=values)


def recent_form(long_df: DataFrame, n: int = schemas.LAST_N) -> DataFrame:
    """Last-``n`` metrics strictly before the contest date, per team.

    Needs ``won``, ``signed_margin``, ``runs_scored``, ``wickets_taken``,
    ``economy_rate`` on the long table. Means skip NULLs; with no history the
    values are 0, 0, 0, 0 and the economy default (10.0); an all-NULL economy
    history also gives the default.
    """
    fields = {"won": F.col("won"), "m": F.col("signed_margin"), "r": F.col("runs_scored"),
              "wk": F.col("wickets_taken"), "e": F.col("economy_rate")}
    p = F.col("_prior")
    size = F.size(p)
    has = size > 0

    def mean(field):
        return safe_ratio(_sum_field(p, field, "double"), _count_field(p, field))

    values = {
        f"win_rate_last_{n}": F.when(has, _sum_field(p, "won") / size).otherwise(F.lit(0.0)),
        f"avg_margin_last_{n}": F.when(has, _sum_field(p, "m", "double") / size).otherwise(F.lit(0.0)),
        f"avg_runs_scored_last_{n}": F.when(has, mean("r")).otherwise(F.lit(0.0)),
        f"avg_wickets_taken_last_{n}": F.when(has, mean("wk")).otherwise(F.lit(0.0)),
        f"avg_economy_rate_last_{n}": F.coalesce(mean("e"), F.lit(schemas.MISSING_ECONOMY)),
    }
    return timeline.prior_rows(long_df, "team", "date", "id", n, fields, strict_time=True, values=values)


def streak_before(long_df: DataFrame, non_win: str = "reset") -> DataFrame:
    """Signed streak entering each contest, in (date, id) order.

    ``non_win='reset'``: a contest neither side won resets to 0 (batch features);
    ``'loss'``: anything but a win counts as a loss.
    """
    lt = _with_outcome(long_df, non_win)
    return timeline.signed_streak(lt, "team", "date", "id", "_o", out_before="streak").drop("_o")


def _with_outcome(long_df: DataFrame, non_win: str) -> DataFrame:
    if non_win == "reset":
        return long_df.withColumn("_o", F.col("outcome"))
    if non_win == "loss":
        return long_df.withColumn("_o", F.when(F.col("won") == 1, 1).otherwise(-1))
    raise ValueError(non_win)


def streak_current(long_df: DataFrame, entity: str = "team", non_win: str = "loss") -> DataFrame:
    """The entity's streak after its latest contest (tie = loss by default)."""
    lt = _with_outcome(long_df, non_win)
    s = timeline.signed_streak(lt, entity, "date", "id", "_o", out_before="_b", out_after="_a")
    return (s.groupBy(entity)
            .agg(F.max_by(F.col("_a"), F.struct("date", "id")).alias("streak")))


def player_streak(contests: DataFrame, plays: DataFrame) -> DataFrame:
    """Current streak per batter, through the team the batter batted for.

    The batter's team in a contest is the smallest batting team among the
    batter's plays there (one value per contest, deterministic).
    """
    bt = (clean.canonical_names(plays).filter(F.col("batter").isNotNull())
          .groupBy("match_id", "batter").agg(F.min("batting_team").alias("team")))
    lt = (bt.join(by_key(clean.canonical_names(contests).select("id", "date", "winner")), bt.match_id == contests.id)
          .select("batter", "id", "date", eq_flag(F.col("winner"), F.col("team")).alias("won")))
    return streak_current(materialize(lt), entity="batter", non_win="loss")


def venue_team_rate(long_df: DataFrame) -> DataFrame:
    """The team's win rate at this venue over earlier contests (0.5 if none).

    Earlier = before in (date, id) order, so same-day earlier contests count. A
    contest with no winner counts as played.
    """
    r = timeline.running(long_df, ["venue", "team"], "date", "id",
                         {"_vp": F.lit(1), "_vw": F.col("won")}, inclusive=False)
    return (r.withColumn("venue_win_rate", F.coalesce(safe_ratio("_vw", "_vp"), F.lit(schemas.UNSEEN_RATE)))
             .drop("_vp", "_vw"))


def h2h_total(contests: DataFrame) -> DataFrame:
    """Head-to-head over the whole table (includes this and later contests).

    Adds team1_h2h_wins, team2_h2h_wins, team1_h2h_winrate, team2_h2h_winrate.
    """
    pk = sides.pair_key(contests)
    lo, hi = F.col("team_a"), F.col("team_b")
    w = F.col("winner")
    rec = pk.groupBy("team_a", "team_b").agg(
        F.count(F.lit(1)).alias("_pm"),
        F.count_if(w.eqNullSafe(lo)).alias("_wa"),
        F.count_if(w.eqNullSafe(hi) & (lo != hi)).alias("_wb"),
    )
    j = pk.join(rec, ["team_a", "team_b"], "left")
    return _h2h_columns(j, "_pm", "_wa", "_wb").drop("team_a", "team_b", "_pm", "_wa", "_wb")


def _h2h_columns(j: DataFrame, pm: str, wa: str, wb: str) -> DataFrame:
    t1_low = F.col("team1") == F.col("team_a")
    w1 = F.when(t1_low, F.col(wa)).otherwise(F.col(wb))
    w2 = F.when(t1_low, F.col(wb)).otherwise(F.col(wa))
    return j.withColumns({
        "team1_h2h_wins": w1.cast("long"),
        "team2_h2h_wins": w2.cast("long"),
        "team1_h2h_winrate": F.coalesce(safe_ratio(w1, pm), F.lit(schemas.UNSEEN_RATE)),
        "team2_h2h_winrate": F.coalesce(safe_ratio(w2, pm), F.lit(schemas.UNSEEN_RATE)),
    })


def h2h_prior(contests: DataFrame) -> DataFrame:
    """A11 without leakage: head-to-head over strictly earlier contests of the pair."""
    pk = sides.pair_key(contests)
    w = F.col("winner")
    r = timeline.running(pk, ["team_a", "team_b"], "date", "id", {
        "_pm": F.lit(1),
        "_wa": eq_flag(w, F.col("team_a")),
        "_wb": F.when(F.col("team_a") != F.col("team_b"), eq_flag(w, F.col("team_b"))).otherwise(0),
    }, inclusive=False)
    return _h2h_columns(r, "_pm", "_wa", "_wb").drop("team_a", "team_b", "_pm", "_wa", "_wb")


def rolling_mean(df: DataFrame, entity: str, values: dict[str, str], n: int = schemas.LAST_N,
                 time: str = "date", tie: str = "match_id") -> DataFrame:
    """Mean of each value over the entity's previous ``n`` rows (shift 1, min 1 row).

    Rows are ordered by (time, tie); the current row is excluded; NULLs are skipped;
    the first row of an entity gets NULL.
    """
    fields = {src: F.col(src) for src in values}
    t = timeline.prior_rows(materialize(df), entity, time, tie, n, fields, strict_time=False)
    p = F.col("_prior")
    return t.withColumns({
        out: safe_ratio(_sum_field(p, src, "double"), _count_field(p, src)) for src, out in values.items()
    }).drop("_prior")


def prev_winner(contests: DataFrame, group: str = "team1") -> DataFrame:
    """Winner of the previous contest of the same ``group`` value (date, id order)."""
    return timeline.lag_value(contests, group, "date", "id", "winner", "winner_prev")


def repeat_count(contests: DataFrame, group: str = "team1", value: str = "winner") -> DataFrame:
    """Running count, per group, of rows whose value equals the previous row's value."""
    lg = timeline.lag_value(contests, group, "date", "id", value, "_prev", keep_cell=True)
    r = timeline.running(lg, group, "date", "id", {"repeat_count": eq_flag(F.col(value), F.col("_prev"))},
                         inclusive=True)
    return r.drop("_prev")
