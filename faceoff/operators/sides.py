"""Two-sided contest reshapes and per-contest flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.functions.columns import eq_flag, flag, pair_high, pair_low, signed_margin

CONTEST_CONTEXT = ["date", "venue", "winner", "result", "result_margin", "toss_winner", "toss_decision"]


def side_long(contests: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row per (contest, side): team, opponent and the side's outcome.

    ``won`` = winner is this team; ``outcome`` = 1 won, -1 the opponent won,
    0 otherwise (tie, no result, NULL). Both structs use the same field names
    so they form one array type.
    """
    keep = [c for c in CONTEST_CONTEXT + (extra or []) if c in contests.columns]

    def side(n: int, team: str, opp: str):
        t, o = F.col(team), F.col(opp)
        won = eq_flag(F.col("winner"), t)
        lost = eq_flag(F.col("winner"), o)
        return F.struct(
            F.lit(n).alias("side"), t.alias("team"), o.alias("opponent"),
            won.alias("won"), (won - F.when(won == 1, 0).otherwise(lost)).alias("outcome"),
            eq_flag(F.col("toss_winner"), t).alias("toss_won"),
        )

    arr = F.array(side(1, "team1", "team2"), side(2, "team2", "team1"))
    return (contests.select("id", *keep, F.explode(arr).alias("_s"))
            .select("id", "_s.*", *keep)
            .withColumn("signed_margin", signed_margin(F.col("won"), "result_margin")))


def distinct_entities(contests: DataFrame) -> DataFrame:
    """Distinct non-null teams over both sides."""
    t = contests.select(F.col("team1").alias("team")).unionByName(contests.select(F.col("team2").alias("team")))
    return t.filter(F.col("team").isNotNull()).distinct()


def pair_key(contests: DataFrame) -> DataFrame:
    """Unordered pair of the two teams as (team_a, team_b), team_a <= team_b."""
    return contests.withColumns({"team_a": pair_low("team1", "team2"), "team_b": pair_high("team1", "team2")})


def contest_flags(contests: DataFrame) -> DataFrame:
    """Outcome and toss flags, NULL compares as false."""
    t1, t2 = F.col("team1"), F.col("team2")
    tw, td = F.col("toss_winner"), F.col("toss_decision")
    toss1 = eq_flag(tw, t1)
    bat = eq_flag(td, F.lit("bat"))
    return contests.withColumns({
        "team1_won": eq_flag(t1, F.col("winner")),
        "chose_to_bat": flag(((tw == t1) & (td == "bat")) | ((tw == t2) & (td == "field"))),
        "team1_won_toss": toss1,
        "toss_winner_is_team1": toss1,
        "team1_bat_first": bat,
        "team1_toss_bat_first": toss1 * bat,
        "team2_toss_bat_first": (1 - toss1) * bat,
        "toss_decides": eq_flag(tw, F.col("winner")),
    })


def home_side(contests: DataFrame) -> DataFrame:
    """P20: team1 plays at home when its name occurs in the venue name."""
    return contests.withColumn("is_home_team", flag(F.col("venue").contains(F.col("team1"))))


def winning_losing_score(df: DataFrame, mode: str = "reference") -> DataFrame:
    """Winning and losing score from the two innings scores.

    ``mode='reference'`` follows the original truth table: team1 won by wickets
    -> (s2, s1), team1 won otherwise -> (s1, s2), team2 won by wickets -> (s1, s2),
    team2 won otherwise -> (s2, s1); another winner -> (max, min); NULL winner ->
    NULL. ``mode='batting_order'`` assumes team1 bats first: the side that won by
    wickets chased, so the winning score is always the winner's own innings.
    """
    s1, s2 = F.col("inning1_score"), F.col("inning2_score")
    w, t1, t2 = F.col("winner"), F.col("team1"), F.col("team2")
    wk = F.col("result").eqNullSafe(schemas.RESULT_BY_WICKETS)
    hi, lo = F.greatest(s1, s2), F.least(s1, s2)
    if mode == "reference":
        pick = (F.when(w.isNull(), F.struct(F.lit(None).cast("long").alias("w"), F.lit(None).cast("long").alias("l")))
                .when((w == t1) & wk, F.struct(s2.alias("w"), s1.alias("l")))
                .when(w == t1, F.struct(s1.alias("w"), s2.alias("l")))
                .when((w == t2) & wk, F.struct(s1.alias("w"), s2.alias("l")))
                .when(w == t2, F.struct(s2.alias("w"), s1.alias("l")))
                .otherwise(F.struct(hi.alias("w"), lo.alias("l"))))
    elif mode == "batting_order":
        pick = (F.when(w.isNull(), F.struct(F.lit(None).cast("long").alias("w"), F.lit(None).cast("long").alias("l")))
                .when(w == t1, F.struct(s1.alias("w"), s2.alias("l")))
                .when(w == t2, F.struct(s2.alias("w"), s1.alias("l")))
                .otherwise(F.struct(hi.alias("w"), lo.alias("l"))))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn("_wl", pick).withColumns(
        {"winning_score": F.col("_wl.w"), "losing_score": F.col("_wl.l")}).drop("_wl")


def to_sides(long_df: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """Inverse of :func:`side_long`: side-1 and side-2 values as team1_*/team2_* columns.

    One grouped aggregate on ``key`` (a single shuffle) instead of two joins.
    """
    aggs = []
    for c in columns:
        aggs.append(F.max(F.when(F.col("side") == 1, F.col(c))).alias(f"team1_{c}"))
        aggs.append(F.max(F.when(F.col("side") == 2, F.col(c))).alias(f"team2_{c}"))
    return long_df.groupBy(key).agg(*aggs)
