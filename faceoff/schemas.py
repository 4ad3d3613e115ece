"""Table schemas and the fixed values the semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Contest table: one row per contest, two sides (team1, team2).
CONTEST = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("season", T.StringType(), True),
    T.StructField("date", T.DateType(), False),
    T.StructField("team1", T.StringType(), False),
    T.StructField("team2", T.StringType(), False),
    T.StructField("venue", T.StringType(), True),
    T.StructField("toss_winner", T.StringType(), True),
    T.StructField("toss_decision", T.StringType(), True),
    T.StructField("winner", T.StringType(), True),
    T.StructField("result", T.StringType(), True),
    T.StructField("result_margin", T.DoubleType(), True),
])

# Play table: one row per play (ball). Players are names; a numeric key is its text.
PLAY = T.StructType([
    T.StructField("match_id", T.LongType(), False),
    T.StructField("inning", T.IntegerType(), False),
    T.StructField("ball", T.IntegerType(), True),
    T.StructField("batter", T.StringType(), True),
    T.StructField("bowler", T.StringType(), True),
    T.StructField("batting_team", T.StringType(), True),
    T.StructField("bowling_team", T.StringType(), True),
    T.StructField("batsman_runs", T.IntegerType(), True),
    T.StructField("total_runs", T.IntegerType(), True),
    T.StructField("is_wicket", T.IntegerType(), True),
    T.StructField("player_dismissed", T.StringType(), True),
    T.StructField("wide_runs", T.IntegerType(), True),
    T.StructField("noball_runs", T.IntegerType(), True),
])

# Alternative column names used by older play files -> canonical name.
PLAY_ALIASES = {"batsman": "batter", "runs": "batsman_runs"}

# Columns a file may lack; all others are required.
CONTEST_OPTIONAL = {"season", "venue", "toss_winner", "toss_decision", "result", "result_margin"}
PLAY_OPTIONAL = {"ball", "player_dismissed", "wide_runs", "noball_runs"}

# ---------------------------------------------------------------------------
# Fixed values (must equal the original project's for equal results)
# ---------------------------------------------------------------------------

# Team renames applied to every team column of contests and plays.
TEAM_NAME_MAPPING = {
    "Delhi Daredevils": "Delhi Capitals",
    "Deccan Chargers": "Sunrisers Hyderabad",
    "Rising Pune Supergiants": "Rising Pune Supergiant",
    "Kings XI Punjab": "Punjab Kings",
}

NO_RESULT = "no result"
RESULT_BY_WICKETS = "wickets"
LAST_N = 5                      # size of the recent-form window
FORM_WEIGHT_DIVISOR = 15.0      # weight of the i-th oldest of the last contests is i/15
UNSEEN_RATE = 0.5               # head-to-head / venue rate with no history
MISSING_ECONOMY = 10.0          # recent economy rate with no history
UNKNOWN_LABEL = "Unknown"       # fill for categorical nulls before encoding
ECONOMY_PATTERN = "economy_rate"

# Scoring request: required strings, then per-side doubles with their defaults.
REQUEST_STRINGS = ["venue", "team1", "team2", "toss_winner", "toss_decision"]
REQUEST_DEFAULTS = {
    "win_rate_last_5": 0.5,
    "avg_margin_last_5": 0.0,
    "avg_runs_scored_last_5": 150.0,
    "avg_wickets_taken_last_5": 5.0,
    "avg_economy_rate_last_5": 8.0,
}
# (min, max) per request field; None = unbounded.
REQUEST_RANGES = {
    "win_rate_last_5": (0.0, 1.0),
    "avg_margin_last_5": (None, None),
    "avg_runs_scored_last_5": (0.0, None),
    "avg_wickets_taken_last_5": (0.0, 10.0),
    "avg_economy_rate_last_5": (0.0, None),
}
TOSS_DECISIONS = ["bat", "field"]
MAX_NAME_LENGTH = 100

REQUEST_DOUBLES = [f"{side}_{k}" for side in ("team1", "team2") for k in REQUEST_DEFAULTS]

REQUEST = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in REQUEST_STRINGS]
    + [T.StructField(c, T.DoubleType(), True) for c in REQUEST_DOUBLES]
)

# Classifier features of the form dataset, in training order.
FORM_FEATURES = [
    "venue", "team1", "team2", "toss_winner", "toss_decision",
    "team1_win_rate_last_5", "team1_avg_margin_last_5",
    "team2_win_rate_last_5", "team2_avg_margin_last_5",
    "team1_avg_runs_scored_last_5", "team1_avg_wickets_taken_last_5", "team1_avg_economy_rate_last_5",
    "team2_avg_runs_scored_last_5", "team2_avg_wickets_taken_last_5", "team2_avg_economy_rate_last_5",
    "toss_winner_is_team1", "team1_bat_first", "team1_toss_bat_first", "team2_toss_bat_first",
]
CATEGORICAL = ["venue", "team1", "team2", "toss_winner", "toss_decision"]
