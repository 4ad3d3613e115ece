"""Independent DuckDB SQL for each registered query (the correctness oracle).

The SQL is written in a different form than the Spark code on purpose: history
features use rank self-joins and island numbering over whole-team windows,
per-contest aggregates use full outer joins, so a mistake in the Spark recipe
shows up as a mismatch. Base tables are the pre-registered parquet views.
"""

from __future__ import annotations

from faceoff import schemas
from faceoff.functions import text

CONTESTS = """contests AS (
  SELECT o.o_orderkey AS id,
    CAST(year(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS season,
    CAST(o.o_orderdate AS DATE) AS date,
    n1.n_name AS team1, n2.n_name AS team2, c.c_mktsegment AS venue,
    CASE WHEN o.o_orderkey % 2 = 0 THEN n1.n_name ELSE n2.n_name END AS toss_winner,
    CASE WHEN o.o_orderkey % 3 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
    CASE o.o_orderstatus WHEN 'F' THEN n1.n_name WHEN 'O' THEN n2.n_name END AS winner,
    CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 5 = 0 THEN 'no result'
         WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 5 = 1 THEN NULL
         WHEN o.o_orderstatus = 'P' THEN 'tie'
         WHEN o.o_orderkey % 7 < 3 THEN 'wickets' ELSE 'runs' END AS result,
    CASE WHEN o.o_orderstatus = 'P' THEN NULL
         ELSE CAST(o.o_orderkey % 90 + 1 AS DOUBLE) END AS result_margin
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n1 ON n1.n_nationkey = c.c_nationkey
  JOIN nation n2 ON n2.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25)"""

PLAYS = """plays AS (
  SELECT l.l_orderkey AS match_id,
    CAST(CASE WHEN l.l_linenumber = 7 THEN 3 ELSE 1 + l.l_linenumber % 2 END AS INTEGER) AS inning,
    CAST(l.l_linenumber AS INTEGER) AS ball,
    CAST(l.l_partkey % 400 AS BIGINT) AS batter,
    CASE WHEN l.l_linenumber = 6 AND l.l_returnflag = 'N' THEN NULL ELSE l.l_suppkey END AS bowler,
    CASE WHEN l.l_linenumber % 2 = 0 THEN c.team1 ELSE c.team2 END AS batting_team,
    CASE WHEN l.l_linenumber % 2 = 0 THEN c.team2 ELSE c.team1 END AS bowling_team,
    CAST(CAST(l.l_quantity AS INT) % 7 AS INTEGER) AS batsman_runs,
    CAST(CAST(l.l_quantity AS INT) % 7 + CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS total_runs,
    CASE WHEN l.l_returnflag = 'A' THEN 1 ELSE 0 END AS is_wicket,
    CAST(CASE WHEN l.l_returnflag = 'A' THEN l.l_partkey % 400 END AS BIGINT) AS player_dismissed,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 1 ELSE 0 END AS wide_runs,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 1 ELSE 0 END AS noball_runs
  FROM lineitem l JOIN contests c ON c.id = l.l_orderkey)"""


def _case_map(col: str, mapping: dict[str, str]) -> str:
    if not mapping:
        return col
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {col} END"


CLEANED = f"""cleaned AS (
  SELECT id, season, date,
    {_case_map('team1', schemas.TEAM_NAME_MAPPING)} AS team1,
    {_case_map('team2', schemas.TEAM_NAME_MAPPING)} AS team2,
    venue,
    {_case_map('toss_winner', schemas.TEAM_NAME_MAPPING)} AS toss_winner,
    toss_decision,
    {_case_map('winner', schemas.TEAM_NAME_MAPPING)} AS winner,
    result, result_margin
  FROM contests WHERE result IS DISTINCT FROM 'no result')"""

FC = f"""fc AS (
  SELECT id, season, date,
    {_case_map('team1', schemas.TEAM_NAME_MAPPING)} AS team1,
    {_case_map('team2', schemas.TEAM_NAME_MAPPING)} AS team2,
    venue,
    {_case_map('toss_winner', schemas.TEAM_NAME_MAPPING)} AS toss_winner,
    toss_decision,
    {_case_map('winner', schemas.TEAM_NAME_MAPPING)} AS winner,
    result, result_margin
  FROM contests WHERE winner IS NOT NULL)"""


def lt_cte(name: str, src: str) -> str:
    """Long side table of ``src`` (two rows per contest)."""
    def side(n, t, o):
        return f"""SELECT id, {n} AS side, {t} AS team, {o} AS opponent, date, venue,
      CASE WHEN winner = {t} THEN 1 ELSE 0 END AS won,
      CASE WHEN winner = {t} THEN 1 WHEN winner = {o} THEN -1 ELSE 0 END AS outcome,
      CASE WHEN toss_winner = {t} THEN 1 ELSE 0 END AS toss_won,
      CASE WHEN winner = {t} THEN coalesce(result_margin, 0.0)
           WHEN coalesce(result_margin, 0.0) = 0 THEN 0.0 ELSE -result_margin END AS signed_margin
    FROM {src}"""
    return f"{name} AS (\n    {side(1, 'team1', 'team2')}\n    UNION ALL\n    {side(2, 'team2', 'team1')})"


INNINGS = """ip AS (
  SELECT match_id AS id,
    CAST(coalesce(sum(CASE WHEN inning = 1 THEN total_runs END), 0) AS BIGINT) AS inning1_score,
    CAST(coalesce(sum(CASE WHEN inning = 2 THEN total_runs END), 0) AS BIGINT) AS inning2_score
  FROM plays WHERE inning IN (1, 2) GROUP BY match_id)"""

BOWLING = """bw AS (
  SELECT match_id, bowling_team AS team,
    CAST(sum(total_runs) AS BIGINT) AS runs_conceded,
    count(ball) AS balls_bowled,
    count(*) FILTER (WHERE wide_runs > 0 OR noball_runs > 0) AS extra_balls,
    count(ball) - count(*) FILTER (WHERE wide_runs > 0 OR noball_runs > 0) AS legal_balls_bowled
  FROM plays WHERE bowling_team IS NOT NULL GROUP BY match_id, bowling_team)"""

TMS = """tms AS (
  SELECT coalesce(r.match_id, w.match_id, b.match_id) AS match_id,
         coalesce(r.team, w.team, b.team) AS team,
         CAST(coalesce(r.runs_scored, 0) AS BIGINT) AS runs_scored,
         CAST(coalesce(w.wickets_taken, 0) AS BIGINT) AS wickets_taken,
         coalesce(b.runs_conceded, 0) AS runs_conceded,
         coalesce(b.legal_balls_bowled, 0) AS legal_balls_bowled,
         CASE WHEN b.legal_balls_bowled <> 0 THEN 6.0 * b.runs_conceded / b.legal_balls_bowled END AS economy_rate
  FROM (SELECT match_id, batting_team AS team, sum(total_runs) AS runs_scored
        FROM plays WHERE batting_team IS NOT NULL GROUP BY 1, 2) r
  FULL OUTER JOIN (SELECT match_id, bowling_team AS team, count(player_dismissed) AS wickets_taken
        FROM plays WHERE bowler IS NOT NULL AND bowling_team IS NOT NULL GROUP BY 1, 2) w
    ON w.match_id = r.match_id AND w.team = r.team
  FULL OUTER JOIN bw b
    ON b.match_id = coalesce(r.match_id, w.match_id) AND b.team = coalesce(r.team, w.team))"""

SIDE_STATS = """st AS (
  SELECT l.id, l.side, l.team, l.date, l.won, l.signed_margin,
         t.runs_scored, t.wickets_taken, t.economy_rate
  FROM fclt l LEFT JOIN tms t ON t.match_id = l.id AND t.team = l.team)"""

# last-5 rows strictly before the date: rank join on (row number, #earlier-date rows)
RANKED = """{name} AS (
  SELECT *, row_number() OVER (PARTITION BY team ORDER BY date, id) AS rn,
         rank() OVER (PARTITION BY team ORDER BY date) - 1 AS k
  FROM {src})"""

LAST5 = """l5 AS (
  SELECT a.id, a.side, a.team,
    CAST(coalesce(sum(b.won), 0) AS BIGINT) AS last5_wins,
    coalesce(sum(b.won * (b.rn - greatest(a.k - 5, 0))), 0) / 15.0 AS form
  FROM rk a LEFT JOIN rk b ON b.team = a.team AND b.rn > a.k - 5 AND b.rn <= a.k
  GROUP BY a.id, a.side, a.team)"""

# streak via islands of equal outcomes in (date, id) order
STREAK = """sk AS (
  SELECT id, side, team,
    CAST(coalesce(lag(aft) OVER (PARTITION BY team ORDER BY date, id), 0) AS BIGINT) AS streak
  FROM (SELECT *, CASE WHEN outcome = 0 THEN 0
                       ELSE outcome * row_number() OVER (PARTITION BY team, outcome, grp ORDER BY date, id) END AS aft
        FROM (SELECT *, row_number() OVER (PARTITION BY team ORDER BY date, id)
                        - row_number() OVER (PARTITION BY team, outcome ORDER BY date, id) AS grp
              FROM lt) g) s)"""

VENUE_RATE = """vr AS (
  SELECT id, side, team,
    CASE WHEN count(*) OVER w > 0 THEN sum(won) OVER w / count(*) OVER w ELSE 0.5 END AS venue_win_rate
  FROM lt
  WINDOW w AS (PARTITION BY venue, team ORDER BY date, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

H2H_TOTAL = """h2h AS (
  SELECT c.id,
    count(*) FILTER (WHERE d.winner = c.team1) AS team1_h2h_wins,
    count(*) FILTER (WHERE d.winner = c.team2) AS team2_h2h_wins,
    count(*) FILTER (WHERE d.winner = c.team1) / count(*) AS team1_h2h_winrate,
    count(*) FILTER (WHERE d.winner = c.team2) / count(*) AS team2_h2h_winrate
  FROM cleaned c JOIN cleaned d
    ON least(d.team1, d.team2) = least(c.team1, c.team2) AND greatest(d.team1, d.team2) = greatest(c.team1, c.team2)
  GROUP BY c.id)"""

H2H_PRIOR = """h2hp AS (
  SELECT c.id,
    count(*) FILTER (WHERE d.winner = c.team1) AS team1_h2h_wins,
    count(*) FILTER (WHERE d.winner = c.team2) AS team2_h2h_wins,
    CASE WHEN count(d.id) > 0 THEN count(*) FILTER (WHERE d.winner = c.team1) / count(d.id) ELSE 0.5 END AS team1_h2h_winrate,
    CASE WHEN count(d.id) > 0 THEN count(*) FILTER (WHERE d.winner = c.team2) / count(d.id) ELSE 0.5 END AS team2_h2h_winrate
  FROM cleaned c LEFT JOIN cleaned d
    ON least(d.team1, d.team2) = least(c.team1, c.team2) AND greatest(d.team1, d.team2) = greatest(c.team1, c.team2)
   AND (d.date < c.date OR (d.date = c.date AND d.id < c.id))
  GROUP BY c.id)"""

RECENT = """rf AS (
  SELECT a.id, a.side, a.team,
    CASE WHEN count(b.id) = 0 THEN 0.0 ELSE sum(b.won) / count(b.id) END AS win_rate_last_5,
    CASE WHEN count(b.id) = 0 THEN 0.0 ELSE sum(b.signed_margin) / count(b.id) END AS avg_margin_last_5,
    CASE WHEN count(b.id) = 0 THEN 0.0 ELSE avg(b.runs_scored) END AS avg_runs_scored_last_5,
    CASE WHEN count(b.id) = 0 THEN 0.0 ELSE avg(b.wickets_taken) END AS avg_wickets_taken_last_5,
    coalesce(avg(b.economy_rate), 10.0) AS avg_economy_rate_last_5
  FROM rks a LEFT JOIN rks b ON b.team = a.team AND b.rn > a.k - 5 AND b.rn <= a.k
  GROUP BY a.id, a.side, a.team)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r6(expr: str, alias: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6) AS {alias}"


BASE = [CONTESTS]
BASE_P = [CONTESTS, PLAYS]

ORACLES: dict[str, str] = {}

ORACLES["scan_contests"] = w(*BASE) + "SELECT * FROM contests"
ORACLES["scan_plays"] = w(*BASE_P) + "SELECT * FROM plays"
ORACLES["drop_no_result"] = w(*BASE) + "SELECT * FROM contests WHERE result IS DISTINCT FROM 'no result'"
ORACLES["require_columns"] = w(*BASE) + "SELECT * FROM contests WHERE winner IS NOT NULL"
RENAMED = {"NATION_1": "NATION_1 UNITED", "NATION_7": "NATION_7 CITY"}
ORACLES["canonical_names"] = w(*BASE) + f"""SELECT id, season, date,
  {_case_map('team1', RENAMED)} AS team1, {_case_map('team2', RENAMED)} AS team2,
  venue, {_case_map('toss_winner', RENAMED)} AS toss_winner, toss_decision,
  {_case_map('winner', RENAMED)} AS winner, result, result_margin FROM contests"""
ORACLES["season_from_date"] = w(*BASE) + "SELECT id, date, CAST(year(date) AS INTEGER) AS season FROM contests"
ORACLES["side_long"] = w(*BASE, lt_cte("lt", "contests")) + \
    f"SELECT id, side, team, opponent, date, won, outcome, toss_won, {r6('signed_margin', 'signed_margin')} FROM lt"
ORACLES["distinct_entities"] = w(*BASE) + """SELECT DISTINCT team FROM
  (SELECT team1 AS team FROM contests UNION ALL SELECT team2 FROM contests) t WHERE team IS NOT NULL"""
ORACLES["pair_key"] = w(*BASE) + "SELECT id, least(team1, team2) AS team_a, greatest(team1, team2) AS team_b FROM contests"
ORACLES["contest_flags"] = w(*BASE) + """SELECT id,
  CASE WHEN team1 = winner THEN 1 ELSE 0 END AS team1_won,
  CASE WHEN (toss_winner = team1 AND toss_decision = 'bat') OR (toss_winner = team2 AND toss_decision = 'field') THEN 1 ELSE 0 END AS chose_to_bat,
  CASE WHEN toss_winner = team1 THEN 1 ELSE 0 END AS team1_won_toss,
  CASE WHEN toss_winner = team1 THEN 1 ELSE 0 END AS toss_winner_is_team1,
  CASE WHEN toss_decision = 'bat' THEN 1 ELSE 0 END AS team1_bat_first,
  CASE WHEN toss_winner = team1 AND toss_decision = 'bat' THEN 1 ELSE 0 END AS team1_toss_bat_first,
  CASE WHEN toss_winner IS DISTINCT FROM team1 AND toss_decision = 'bat' THEN 1 ELSE 0 END AS team2_toss_bat_first,
  CASE WHEN toss_winner = winner THEN 1 ELSE 0 END AS toss_decides
FROM contests"""
ORACLES["home_side"] = w(*BASE) + \
    """SELECT id, venue, team1, CASE WHEN contains(venue, team1) THEN 1 ELSE 0 END AS is_home_team FROM (
  SELECT id, venue, team1 FROM contests
  UNION ALL SELECT -id, 'Park of ' || CASE id % 3 WHEN 0 THEN team1 WHEN 1 THEN team2 END || ' East', team1 FROM contests WHERE id % 11 < 4) x"""

WL_CASE = """CASE WHEN winner IS NULL THEN NULL
       WHEN winner = team1 AND result = 'wickets' THEN {s2}
       WHEN winner = team1 THEN {s1}
       WHEN winner = team2 AND result = 'wickets' THEN {s1}
       WHEN winner = team2 THEN {s2}
       ELSE greatest({s1}, {s2}) END"""
WINNING = WL_CASE.format(s1="inning1_score", s2="inning2_score")
LOSING = WL_CASE.format(s1="inning2_score", s2="inning1_score").replace("greatest(", "least(")

ORACLES["winning_losing_score"] = w(*BASE_P, INNINGS) + f"""SELECT id, inning1_score, inning2_score,
  CAST({WINNING} AS BIGINT) AS winning_score, CAST({LOSING} AS BIGINT) AS losing_score
FROM (SELECT c.id, c.team1, c.team2, c.winner, c.result,
             coalesce(ip.inning1_score, 0) AS inning1_score, coalesce(ip.inning2_score, 0) AS inning2_score
      FROM contests c LEFT JOIN ip ON ip.id = c.id) s"""

ORACLES["winning_losing_score_batting_order"] = w(*BASE_P, INNINGS) + """SELECT c.id,
  CASE c.winner WHEN c.team1 THEN s1 WHEN c.team2 THEN s2 ELSE CASE WHEN c.winner IS NOT NULL THEN greatest(s1, s2) END END AS winning_score,
  CASE c.winner WHEN c.team1 THEN s2 WHEN c.team2 THEN s1 ELSE CASE WHEN c.winner IS NOT NULL THEN least(s1, s2) END END AS losing_score
FROM contests c JOIN (SELECT d.id, coalesce(inning1_score, 0) AS s1, coalesce(inning2_score, 0) AS s2
                      FROM contests d LEFT JOIN ip ON ip.id = d.id) s ON s.id = c.id"""

ORACLES["team_career"] = w(*BASE, CLEANED) + f"""SELECT t.team, coalesce(m.n, 0) AS total_matches,
  coalesce(wi.n, 0) AS total_wins,
  {r6('CASE WHEN coalesce(m.n, 0) > 0 THEN coalesce(wi.n, 0) / m.n ELSE 0 END', 'win_rate')},
  {r6('CASE WHEN coalesce(m.n, 0) > 0 THEN coalesce(ts.n, 0) / m.n ELSE 0 END', 'toss_win_rate')},
  {r6('CASE WHEN coalesce(h.n, 0) > 0 THEN h.w / h.n ELSE 0 END', 'home_win_rate')},
  {r6('CASE WHEN coalesce(a.n, 0) > 0 THEN a.w / a.n ELSE 0 END', 'away_win_rate')}
FROM (SELECT DISTINCT team FROM (SELECT team1 AS team FROM cleaned UNION ALL SELECT team2 FROM cleaned) x WHERE team IS NOT NULL) t
LEFT JOIN (SELECT team, count(*) AS n FROM (SELECT id, team1 AS team FROM cleaned UNION SELECT id, team2 FROM cleaned) u GROUP BY team) m ON m.team = t.team
LEFT JOIN (SELECT winner AS team, count(*) AS n FROM cleaned GROUP BY winner) wi ON wi.team = t.team
LEFT JOIN (SELECT toss_winner AS team, count(*) AS n FROM cleaned GROUP BY toss_winner) ts ON ts.team = t.team
LEFT JOIN (SELECT team1 AS team, count(*) AS n, count(*) FILTER (WHERE winner = team1) AS w FROM cleaned GROUP BY team1) h ON h.team = t.team
LEFT JOIN (SELECT team2 AS team, count(*) AS n, count(*) FILTER (WHERE winner = team2) AS w FROM cleaned GROUP BY team2) a ON a.team = t.team"""

ORACLES["venue_stats"] = w(*BASE_P, CLEANED) + f"""SELECT v.venue, v.total_matches, mw.most_successful_team,
  {r6('v.toss_eq / v.total_matches', 'toss_win_impact')},
  {r6('coalesce(fi.afi, 0.0)', 'avg_first_innings_score')}
FROM (SELECT venue, count(*) AS total_matches, count(*) FILTER (WHERE toss_winner = winner) AS toss_eq
      FROM cleaned WHERE venue IS NOT NULL GROUP BY venue) v
LEFT JOIN (SELECT venue, winner AS most_successful_team FROM (
             SELECT venue, winner, row_number() OVER (PARTITION BY venue ORDER BY count(*) DESC, winner ASC) AS rn
             FROM cleaned WHERE venue IS NOT NULL AND winner IS NOT NULL GROUP BY venue, winner) z WHERE rn = 1) mw
  ON mw.venue = v.venue
LEFT JOIN (SELECT c.venue, avg(s.fi) AS afi
           FROM (SELECT match_id, sum(total_runs) AS fi FROM plays WHERE inning = 1 GROUP BY match_id) s
           JOIN cleaned c ON c.id = s.match_id GROUP BY c.venue) fi ON fi.venue = v.venue"""

ORACLES["batter_career"] = w(*BASE_P) + f"""SELECT batter, CAST(sum(batsman_runs) AS BIGINT) AS total_runs,
  count(match_id) AS balls_faced,
  count(*) FILTER (WHERE batsman_runs = 4) AS fours, count(*) FILTER (WHERE batsman_runs = 6) AS sixes,
  {r6('sum(batsman_runs) / count(match_id) * 100', 'strike_rate')}
FROM plays WHERE batter IS NOT NULL GROUP BY batter"""

ORACLES["bowler_career"] = w(*BASE_P) + f"""SELECT bowler, {r6('count(match_id) / 6.0', 'overs_bowled')},
  CAST(sum(is_wicket) AS BIGINT) AS wickets, CAST(sum(total_runs) AS BIGINT) AS runs_conceded,
  {r6('sum(total_runs) / (count(match_id) / 6.0)', 'economy')}
FROM plays WHERE bowler IS NOT NULL GROUP BY bowler"""

LEGAL = "sum(CASE WHEN wide_runs > 0 OR noball_runs > 0 THEN 0 ELSE 1 END)"
ORACLES["batter_career_legal"] = w(*BASE_P) + f"""SELECT batter, CAST(sum(batsman_runs) AS BIGINT) AS total_runs,
  CAST({LEGAL} AS BIGINT) AS balls_faced,
  count(*) FILTER (WHERE batsman_runs = 4) AS fours, count(*) FILTER (WHERE batsman_runs = 6) AS sixes,
  {r6(f'sum(batsman_runs) / nullif({LEGAL}, 0) * 100', 'strike_rate')}
FROM plays WHERE batter IS NOT NULL GROUP BY batter"""
ORACLES["bowler_career_legal"] = w(*BASE_P) + f"""SELECT bowler, {r6(f'{LEGAL} / 6.0', 'overs_bowled')},
  CAST(sum(is_wicket) AS BIGINT) AS wickets, CAST(sum(total_runs) AS BIGINT) AS runs_conceded,
  {r6(f'sum(total_runs) / nullif({LEGAL} / 6.0, 0)', 'economy')}
FROM plays WHERE bowler IS NOT NULL GROUP BY bowler"""

PLAYER_MATCH = """SELECT match_id, batter, CAST(sum(batsman_runs) AS BIGINT) AS runs_scored, count(match_id) AS balls_faced
FROM plays WHERE batter IS NOT NULL AND match_id IN (SELECT id FROM cleaned) GROUP BY match_id, batter"""
ORACLES["player_match"] = w(*BASE_P, CLEANED) + PLAYER_MATCH
ORACLES["positive_exposure"] = w(*BASE_P, CLEANED) + f"""SELECT * FROM (
  SELECT * FROM ({PLAYER_MATCH}) a
  UNION ALL SELECT * REPLACE (0 AS balls_faced) FROM ({PLAYER_MATCH}) b WHERE batter % 5 = 0
  UNION ALL SELECT * REPLACE (NULL AS balls_faced) FROM ({PLAYER_MATCH}) c WHERE batter % 5 = 0) pm
WHERE balls_faced > 0"""
ORACLES["innings_pivot"] = w(*BASE_P, INNINGS) + "SELECT * FROM ip"
ORACLES["bowling_match"] = w(*BASE_P, BOWLING) + f"""SELECT match_id, team, runs_conceded, balls_bowled, extra_balls,
  legal_balls_bowled, {r6('CASE WHEN legal_balls_bowled <> 0 THEN runs_conceded * 6.0 / legal_balls_bowled END', 'economy_rate')}
FROM bw"""
TMS_SELECT = f"""SELECT match_id, team, runs_scored, wickets_taken, runs_conceded, legal_balls_bowled,
  {r6('economy_rate', 'economy_rate')} FROM tms"""
ORACLES["team_match_stats"] = w(*BASE_P, BOWLING, TMS) + TMS_SELECT
_MAIN = "main_plays AS (SELECT * FROM plays WHERE inning <= 2)"
ORACLES["team_match_stats_main_innings"] = w(*BASE_P, _MAIN, *[x.replace("FROM plays", "FROM main_plays") for x in (BOWLING, TMS)]) + TMS_SELECT
ORACLES["finite_only"] = f"""SELECT * REPLACE (CASE WHEN isfinite(economy_rate) THEN economy_rate END AS economy_rate) FROM (
  SELECT * FROM ({ORACLES["team_match_stats"]}) t
  UNION ALL SELECT * REPLACE (-match_id AS match_id, CASE match_id % 7 WHEN 0 THEN 'inf'::DOUBLE WHEN 1 THEN 'nan'::DOUBLE
    WHEN 2 THEN '-inf'::DOUBLE ELSE economy_rate END AS economy_rate) FROM ({ORACLES["team_match_stats"]}) u WHERE match_id % 7 <= 3) z"""
ORACLES["fill_defaults"] = w(*BASE_P, BOWLING, TMS) + f"""SELECT match_id, team, runs_scored, wickets_taken,
  runs_conceded, legal_balls_bowled, {r6('coalesce(economy_rate, 10.0)', 'economy_rate')} FROM tms"""
ORACLES["batting_average"] = w(*BASE_P) + f"""SELECT batter,
  {r6('sum(batsman_runs) / count(DISTINCT match_id)', 'batting_average')}
FROM plays WHERE batter IS NOT NULL GROUP BY batter"""
ORACLES["team_last_n_runs"] = w(*BASE_P, FC) + f"""SELECT team, {r6('coalesce(sum(r.r), 0) / count(*)', 'avg_runs_last_n')}
FROM (SELECT * FROM (SELECT team, id, row_number() OVER (PARTITION BY team ORDER BY date DESC, id DESC) AS rn
      FROM (SELECT id, date, team1 AS team FROM fc UNION ALL SELECT id, date, team2 FROM fc) u) z WHERE rn <= 5) t
LEFT JOIN (SELECT match_id, sum(batsman_runs) AS r FROM plays WHERE batter IS NOT NULL GROUP BY match_id) r
  ON r.match_id = t.id
GROUP BY team"""
ORACLES["player_recent_form"] = w(*BASE_P) + f"""SELECT batter, {r6('sum(batsman_runs) / 5.0', 'recent_form')}
FROM (SELECT batter, batsman_runs, row_number() OVER (PARTITION BY batter
        ORDER BY match_id DESC, inning DESC, ball DESC, batsman_runs DESC) AS rn
      FROM plays WHERE batter IS NOT NULL) z WHERE rn <= 5 GROUP BY batter"""
ORACLES["plays_with_venue"] = w(*BASE_P, CLEANED) + """SELECT p.match_id, p.inning, p.ball, p.batter, p.total_runs, c.venue
FROM plays p JOIN cleaned c ON c.id = p.match_id"""
ORACLES["contests_of_player"] = w(*BASE_P, CLEANED) + """SELECT DISTINCT p.batter, c.id, c.date, c.winner
FROM plays p JOIN cleaned c ON c.id = p.match_id WHERE p.batter IS NOT NULL"""
ORACLES["contest_scores"] = w(*BASE_P, FC, INNINGS) + """SELECT fc.id, coalesce(ip.inning1_score, 0) AS inning1_score,
  coalesce(ip.inning2_score, 0) AS inning2_score FROM fc LEFT JOIN ip ON ip.id = fc.id"""
ORACLES["side_stats"] = w(*BASE_P, FC, lt_cte("fclt", "fc"), BOWLING, TMS, SIDE_STATS) + f"""SELECT id, side, team, date, won,
  {r6('signed_margin', 'signed_margin')}, runs_scored, wickets_taken, {r6('economy_rate', 'economy_rate')} FROM st"""

LT_CLEAN = [*BASE, CLEANED, lt_cte("lt", "cleaned")]
ORACLES["last5_wins"] = w(*LT_CLEAN, RANKED.format(name="rk", src="lt"), LAST5) + \
    f"SELECT id, side, team, last5_wins, {r6('form', 'form')} FROM l5"
ORACLES["form_score"] = w(*LT_CLEAN, RANKED.format(name="rk", src="lt"), LAST5) + f"""SELECT id,
  {r6('max(CASE WHEN side = 1 THEN form END)', 'team1_form')}, {r6('max(CASE WHEN side = 2 THEN form END)', 'team2_form')}
FROM l5 GROUP BY id"""
ORACLES["streak_before"] = w(*LT_CLEAN, STREAK) + "SELECT * FROM sk"

STREAK_LOSS = """SELECT {ent}, CAST(aft AS BIGINT) AS streak FROM (
  SELECT *, o * row_number() OVER (PARTITION BY {ent}, o, grp ORDER BY date, id) AS aft,
         row_number() OVER (PARTITION BY {ent} ORDER BY date DESC, id DESC) AS last_rn
  FROM (SELECT *, row_number() OVER (PARTITION BY {ent} ORDER BY date, id)
                  - row_number() OVER (PARTITION BY {ent}, o ORDER BY date, id) AS grp
        FROM (SELECT *, CASE WHEN won = 1 THEN 1 ELSE -1 END AS o FROM {src}) a) g) s
WHERE last_rn = 1"""
ORACLES["streak_current"] = w(*BASE, FC, lt_cte("fclt", "fc")) + STREAK_LOSS.format(ent="team", src="fclt")
ORACLES["player_streak"] = w(*BASE_P, FC, """bt AS (
  SELECT b.batter, fc.id, fc.date, CASE WHEN fc.winner = b.team THEN 1 ELSE 0 END AS won
  FROM (SELECT match_id, batter, min(batting_team) AS team FROM plays WHERE batter IS NOT NULL GROUP BY 1, 2) b
  JOIN fc ON fc.id = b.match_id)""") + STREAK_LOSS.format(ent="batter", src="bt")
ORACLES["venue_team_rate"] = w(*LT_CLEAN, VENUE_RATE) + f"SELECT id, side, team, {r6('venue_win_rate', 'venue_win_rate')} FROM vr"
H2H_SELECT = f"""SELECT id, CAST(team1_h2h_wins AS BIGINT) AS team1_h2h_wins, CAST(team2_h2h_wins AS BIGINT) AS team2_h2h_wins,
  {r6('team1_h2h_winrate', 'team1_h2h_winrate')}, {r6('team2_h2h_winrate', 'team2_h2h_winrate')} FROM """
ORACLES["h2h_total"] = w(*BASE, CLEANED, H2H_TOTAL) + H2H_SELECT + "h2h"
ORACLES["h2h_prior"] = w(*BASE, CLEANED, H2H_PRIOR) + H2H_SELECT + "h2hp"
RF_BASE = [*BASE_P, FC, lt_cte("fclt", "fc"), BOWLING, TMS, SIDE_STATS, RANKED.format(name="rks", src="st"), RECENT]
FORM_METRICS = ["win_rate_last_5", "avg_margin_last_5", "avg_runs_scored_last_5", "avg_wickets_taken_last_5",
                "avg_economy_rate_last_5"]
ORACLES["recent_form"] = w(*RF_BASE) + "SELECT id, side, team, " + ", ".join(r6(m, m) for m in FORM_METRICS) + " FROM rf"
ORACLES["prev_winner"] = w(*BASE, CLEANED) + """SELECT id, team1, winner,
  lag(winner) OVER (PARTITION BY team1 ORDER BY date, id) AS winner_prev FROM cleaned"""
ORACLES["repeat_count"] = w(*BASE, CLEANED) + """SELECT id, team1, winner,
  CAST(sum(CASE WHEN winner = pw THEN 1 ELSE 0 END) OVER (PARTITION BY team1 ORDER BY date, id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS repeat_count
FROM (SELECT *, lag(winner) OVER (PARTITION BY team1 ORDER BY date, id) AS pw FROM cleaned) z"""
ORACLES["latest_n_contests"] = w(*LT_CLEAN) + """SELECT team, id, date, won, CAST(recency AS INTEGER) AS recency FROM (
  SELECT team, id, date, won, row_number() OVER (PARTITION BY team ORDER BY date DESC, id DESC) AS recency FROM lt) z
WHERE recency <= 5"""

# --- composed datasets ---------------------------------------------------------------


def raw(expr: str, alias: str) -> str:
    return f"{expr} AS {alias}"


MOMENTUM_CTES = [*LT_CLEAN, RANKED.format(name="rk", src="lt"), LAST5, STREAK, VENUE_RATE, H2H_TOTAL]


def momentum_body(rd=r6) -> str:
    return f"""SELECT c.id, c.season, c.date,
  c.team1, c.team2, c.venue, c.toss_winner, c.toss_decision,
  CASE WHEN (c.toss_winner = c.team1 AND c.toss_decision = 'bat') OR (c.toss_winner = c.team2 AND c.toss_decision = 'field') THEN 1 ELSE 0 END AS chose_to_bat,
  CASE WHEN c.toss_winner = c.team1 THEN 1 ELSE 0 END AS team1_won_toss,
  a1.last5_wins AS team1_last5_wins, a2.last5_wins AS team2_last5_wins,
  {rd('a1.form', 'team1_form')}, {rd('a2.form', 'team2_form')},
  CAST(h.team1_h2h_wins AS BIGINT) AS team1_h2h_wins, CAST(h.team2_h2h_wins AS BIGINT) AS team2_h2h_wins,
  {rd('h.team1_h2h_winrate', 'team1_h2h_winrate')}, {rd('h.team2_h2h_winrate', 'team2_h2h_winrate')},
  s1.streak AS team1_streak, s2.streak AS team2_streak,
  {rd('v1.venue_win_rate', 'team1_venue_win_rate')}, {rd('v2.venue_win_rate', 'team2_venue_win_rate')},
  c.winner, CASE WHEN c.team1 = c.winner THEN 1 ELSE 0 END AS team1_won
FROM cleaned c
JOIN h2h h ON h.id = c.id
JOIN l5 a1 ON a1.id = c.id AND a1.side = 1 JOIN l5 a2 ON a2.id = c.id AND a2.side = 2
JOIN sk s1 ON s1.id = c.id AND s1.side = 1 JOIN sk s2 ON s2.id = c.id AND s2.side = 2
JOIN vr v1 ON v1.id = c.id AND v1.side = 1 JOIN vr v2 ON v2.id = c.id AND v2.side = 2"""


ORACLES["contest_momentum"] = w(*MOMENTUM_CTES) + momentum_body()

FORM_WL = """CASE WHEN winner = team1 AND result = 'wickets' THEN {s2}
       WHEN winner = team1 THEN {s1}
       WHEN winner = team2 AND result = 'wickets' THEN {s1}
       WHEN winner = team2 THEN {s2}
       ELSE {agg}({s1}, {s2}) END"""
FORM_CTES = [*RF_BASE, INNINGS]


def form_body(rd=r6) -> str:
    return f"""SELECT c.id, c.date, c.team1, c.team2, c.venue, c.toss_winner, c.toss_decision, c.winner,
  coalesce(ip.inning1_score, 0) AS inning1_score, coalesce(ip.inning2_score, 0) AS inning2_score,
  CAST({FORM_WL.format(s1='coalesce(ip.inning1_score, 0)', s2='coalesce(ip.inning2_score, 0)', agg='greatest')} AS BIGINT) AS winning_score,
  CAST({FORM_WL.format(s1='coalesce(ip.inning2_score, 0)', s2='coalesce(ip.inning1_score, 0)', agg='least')} AS BIGINT) AS losing_score,
  {', '.join(rd(f'f{s}.{m}', f'team{s}_{m}') for s in (1, 2) for m in FORM_METRICS)},
  CASE WHEN c.toss_winner = c.team1 THEN 1 ELSE 0 END AS toss_winner_is_team1,
  CASE WHEN c.toss_decision = 'bat' THEN 1 ELSE 0 END AS team1_bat_first,
  CASE WHEN c.toss_winner = c.team1 AND c.toss_decision = 'bat' THEN 1 ELSE 0 END AS team1_toss_bat_first,
  CASE WHEN c.toss_winner IS DISTINCT FROM c.team1 AND c.toss_decision = 'bat' THEN 1 ELSE 0 END AS team2_toss_bat_first,
  CASE WHEN c.winner = c.team1 THEN 1 ELSE 0 END AS team1_won
FROM fc c LEFT JOIN ip ON ip.id = c.id
JOIN rf f1 ON f1.id = c.id AND f1.side = 1 JOIN rf f2 ON f2.id = c.id AND f2.side = 2"""


ORACLES["contest_form"] = w(*FORM_CTES) + form_body()

MOM = f"mom AS ({momentum_body(raw)})"
FORM = f"form AS ({form_body(raw)})"
CATS = ["venue", "team1", "team2", "toss_winner", "toss_decision"]
SCALE = [f"team{s}_{m}" for s in (1, 2) for m in FORM_METRICS]


def enc(col: str, src: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY coalesce({col}, 'Unknown')) - 1 AS INTEGER) AS {col}"


MOM_ENC_COLS = ["id", "season", "date", "team1", "team2", "venue", "toss_winner", "toss_decision", "chose_to_bat",
                "team1_won_toss", "team1_last5_wins", "team2_last5_wins", "team1_form", "team2_form",
                "team1_h2h_wins", "team2_h2h_wins", "team1_h2h_winrate", "team2_h2h_winrate",
                "team1_streak", "team2_streak", "team1_venue_win_rate", "team2_venue_win_rate", "winner", "team1_won"]
ENC = "enc AS (SELECT " + ", ".join(enc(c, "mom") if c in CATS else c for c in MOM_ENC_COLS) + " FROM mom)"
MOM_DOUBLES = {"team1_form", "team2_form", "team1_h2h_winrate", "team2_h2h_winrate",
               "team1_venue_win_rate", "team2_venue_win_rate"}
ORACLES["label_encode"] = w(*MOMENTUM_CTES, MOM, ENC) + "SELECT " + ", ".join(
    r6(c, c) if c in MOM_DOUBLES else c for c in MOM_ENC_COLS) + " FROM enc"

CORR_FEATURES = [c for c in MOM_ENC_COLS if c not in ("date", "winner", "team1_won")]
CORR = "corr AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(team1_won AS DOUBLE)) AS correlation FROM enc"
    for c in CORR_FEATURES) + ")"
CORR_CLEAN = "corrc AS (SELECT feature, CASE WHEN isnan(correlation) THEN NULL ELSE correlation END AS correlation FROM corr)"
ORACLES["target_correlation"] = w(*MOMENTUM_CTES, MOM, ENC, CORR, CORR_CLEAN) + \
    f"SELECT feature, {r6('correlation', 'correlation')} FROM corrc"
ORACLES["top_features"] = w(*MOMENTUM_CTES, MOM, ENC, CORR, CORR_CLEAN) + f"""
SELECT feature, {r6('correlation', 'correlation')}, 'top' AS "end" FROM (
  SELECT * FROM corrc WHERE correlation IS NOT NULL ORDER BY correlation DESC, feature LIMIT 10) t
UNION ALL
SELECT feature, {r6('correlation', 'correlation')}, 'bottom' AS "end" FROM (
  SELECT * FROM corrc WHERE correlation IS NOT NULL ORDER BY correlation ASC, feature LIMIT 10) b"""
ORACLES["category_by_target"] = w(*MOMENTUM_CTES, MOM) + \
    "SELECT toss_decision, team1_won, count(*) AS n FROM mom GROUP BY toss_decision, team1_won"
BOX = ["team1_h2h_winrate", "team1_form", "team1_venue_win_rate"]
ORACLES["box_stats"] = w(*MOMENTUM_CTES, MOM, "lv AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, team1_won, CAST({c} AS DOUBLE) AS value FROM mom WHERE {c} IS NOT NULL" for c in BOX) + ")",
    """qs AS (SELECT feature, team1_won, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM lv GROUP BY feature, team1_won)""") + f"""SELECT q.feature, q.team1_won,
  {r6('q.q1', 'q1')}, {r6('q.median', 'median')}, {r6('q.q3', 'q3')}, {r6('q.q3 - q.q1', 'iqr')},
  {r6('min(CASE WHEN l.value >= q.q1 - 1.5 * (q.q3 - q.q1) THEN l.value END)', 'whisker_low')},
  {r6('max(CASE WHEN l.value <= q.q3 + 1.5 * (q.q3 - q.q1) THEN l.value END)', 'whisker_high')},
  count(*) FILTER (WHERE l.value < q.q1 - 1.5 * (q.q3 - q.q1) OR l.value > q.q3 + 1.5 * (q.q3 - q.q1)) AS outliers,
  count(*) AS n
FROM lv l JOIN qs q ON q.feature = l.feature AND q.team1_won = l.team1_won
GROUP BY q.feature, q.team1_won, q.q1, q.median, q.q3"""
ORACLES["median_impute"] = w(*BASE_P, FC, lt_cte("fclt", "fc"), BOWLING, TMS, SIDE_STATS) + \
    f"SELECT id, side, {r6('coalesce(economy_rate, (SELECT median(economy_rate) FROM st))', 'economy_rate')} FROM st"
ORACLES["class_balance"] = w(*FORM_CTES, FORM) + \
    f"SELECT team1_won, count(*) AS n, {r6('count(*) / sum(count(*)) OVER ()', 'share')} FROM form GROUP BY team1_won"

TS_FEATURES = CATS + SCALE + ["toss_winner_is_team1", "team1_bat_first", "team1_toss_bat_first", "team2_toss_bat_first"]
TS = """ts AS (SELECT id, """ + ", ".join(
    enc(c, "form") if c in CATS else
    (f"coalesce({c}, (SELECT median({c}) FROM form)) AS {c}" if "economy" in c else c)
    for c in TS_FEATURES) + ", team1_won, winning_score, losing_score FROM form)"
TS_DOUBLES = set(SCALE)
ORACLES["training_set"] = w(*FORM_CTES, FORM, TS) + "SELECT id, " + ", ".join(
    r6(c, c) if c in TS_DOUBLES else c for c in TS_FEATURES) + ", team1_won, winning_score, losing_score FROM ts"


def hash_expr(seed: int, key: str = "id") -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


TEST_CUT = int(0.2 * (1 << 32))
STRAT = f"""strat AS (SELECT *, CASE WHEN rn <= round(nc * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY team1_won ORDER BY h, id) AS rn,
         count(*) OVER (PARTITION BY team1_won) AS nc
  FROM (SELECT *, {hash_expr(42)} AS h FROM ts) a) b)"""
ORACLES["split_stratified"] = w(*FORM_CTES, FORM, TS, STRAT) + "SELECT id, team1_won, split FROM strat"
ORACLES["split_random"] = w(*FORM_CTES, FORM, TS) + \
    f"SELECT id, CASE WHEN {hash_expr(42)} < {TEST_CUT} THEN 'test' ELSE 'train' END AS split FROM ts"
ORACLES["class_weights"] = w(*FORM_CTES, FORM, TS, STRAT) + f"""SELECT team1_won, n,
  {r6('sum(n) OVER () / (count(*) OVER () * n)', 'balanced_weight')},
  {r6('CASE WHEN sum(CASE WHEN team1_won = 1 THEN n ELSE 0 END) OVER () > 0 THEN (sum(n) OVER () - sum(CASE WHEN team1_won = 1 THEN n ELSE 0 END) OVER ()) / sum(CASE WHEN team1_won = 1 THEN n ELSE 0 END) OVER () ELSE 1.0 END', 'scale_pos_weight')}
FROM (SELECT team1_won, count(*) AS n FROM strat WHERE split = 'train' GROUP BY team1_won) g"""
ORACLES["impute_scale"] = w(*FORM_CTES, FORM) + "SELECT id, " + ", ".join(
    r6(f"(coalesce({c}, avg({c}) OVER ()) - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 "
       f"THEN stddev_pop({c}) OVER () ELSE 1 END", c) for c in SCALE) + " FROM form"
BASE_TEST = ("bt AS (SELECT team1_won, CASE WHEN team1_win_rate_last_5 >= team2_win_rate_last_5 THEN 1 ELSE 0 END "
             "AS prediction FROM strat WHERE split = 'test')")
ORACLES["classification_metrics"] = w(*FORM_CTES, FORM, TS, STRAT, BASE_TEST) + f"""SELECT count(*) AS n,
  {r6('count(*) FILTER (WHERE team1_won = prediction) / count(*)', 'accuracy')},
  {r6('coalesce(count(*) FILTER (WHERE team1_won = 1 AND prediction = 1) / nullif(count(*) FILTER (WHERE prediction = 1), 0), 0)', 'precision')},
  {r6('coalesce(count(*) FILTER (WHERE team1_won = 1 AND prediction = 1) / nullif(count(*) FILTER (WHERE team1_won = 1), 0), 0)', 'recall')},
  {r6('coalesce(2 * p * r / nullif(p + r, 0), 0)', 'f1')}
FROM bt, (SELECT coalesce(count(*) FILTER (WHERE team1_won = 1 AND prediction = 1) / nullif(count(*) FILTER (WHERE prediction = 1), 0), 0) AS p,
                 coalesce(count(*) FILTER (WHERE team1_won = 1 AND prediction = 1) / nullif(count(*) FILTER (WHERE team1_won = 1), 0), 0) AS r FROM bt) pr
GROUP BY p, r"""
ORACLES["classification_report"] = w(*FORM_CTES, FORM, TS, STRAT, BASE_TEST, """per AS (
  SELECT cls, coalesce(tp / nullif(pred, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, support
  FROM (SELECT c.cls,
          (SELECT count(*) FROM bt WHERE CAST(team1_won AS VARCHAR) = c.cls) AS support,
          (SELECT count(*) FROM bt WHERE CAST(prediction AS VARCHAR) = c.cls) AS pred,
          (SELECT count(*) FROM bt WHERE CAST(team1_won AS VARCHAR) = c.cls AND team1_won = prediction) AS tp
        FROM (SELECT CAST(team1_won AS VARCHAR) AS cls FROM bt UNION SELECT CAST(prediction AS VARCHAR) FROM bt) c) z)""",
    "perf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM per)") + f"""
SELECT cls, {r6('precision', 'precision')}, {r6('recall', 'recall')}, CAST(support AS BIGINT) AS support, {r6('f1', 'f1')} FROM perf
UNION ALL
SELECT 'macro avg', {r6('avg(precision)', 'precision')}, {r6('avg(recall)', 'recall')}, CAST(sum(support) AS BIGINT), {r6('avg(f1)', 'f1')} FROM perf
UNION ALL
SELECT 'weighted avg', {r6('sum(precision * support) / sum(support)', 'precision')}, {r6('sum(recall * support) / sum(support)', 'recall')},
  CAST(sum(support) AS BIGINT), {r6('sum(f1 * support) / sum(support)', 'f1')} FROM perf"""
ORACLES["regression_metrics"] = w(*FORM_CTES, FORM, TS) + f"""SELECT count(*) AS n, {r6('avg(abs(e))', 'mae')},
  {r6('avg(e * e)', 'mse')}, {r6('sqrt(avg(e * e))', 'rmse')}
FROM (SELECT greatest(coalesce(team1_avg_runs_scored_last_5, 0.0), coalesce(team2_avg_runs_scored_last_5, 0.0))
             - winning_score AS e FROM ts WHERE {hash_expr(123)} < {TEST_CUT}) z"""

REQ_DOUBLES = [f"{s}_{k}" for s in ("team1", "team2") for k in
               ["win_rate_last_5", "avg_margin_last_5", "avg_runs_scored_last_5", "avg_wickets_taken_last_5",
                "avg_economy_rate_last_5"]]
# Fixed values: (least, most) of a request's numbers.
RANGES = {"win_rate_last_5": (0.0, 1.0), "avg_margin_last_5": (None, None), "avg_runs_scored_last_5": (0.0, None),
          "avg_wickets_taken_last_5": (0.0, 10.0), "avg_economy_rate_last_5": (0.0, None)}


def _violations() -> str:
    parts = []
    for c in CATS:
        parts.append(f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN '{c}_missing' END")
        parts.append(f"CASE WHEN length({c}) > 100 THEN '{c}_too_long' END")
    parts.append("CASE WHEN toss_decision NOT IN ('bat', 'field') THEN 'toss_decision_invalid' END")
    for s in ("team1", "team2"):
        for k, (lo, hi) in RANGES.items():
            if lo is not None:
                parts.append(f"CASE WHEN {s}_{k} < {lo} THEN '{s}_{k}_below_min' END")
            if hi is not None:
                parts.append(f"CASE WHEN {s}_{k} > {hi} THEN '{s}_{k}_above_max' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


REQ = "req AS (SELECT id, " + ", ".join(CATS + REQ_DOUBLES) + " FROM form)"
# more requests, each of which breaks rules
_BAD = {"id": "-id", "venue": "CASE id % 12 WHEN 0 THEN NULL WHEN 1 THEN repeat('v', 101) WHEN 2 THEN '  ' ELSE venue END",
        "team2": "CASE WHEN id % 12 IN (0, 3) THEN '' ELSE team2 END", "toss_decision": "CASE id % 12 WHEN 4 THEN 'bowl' ELSE toss_decision END",
        "team1_win_rate_last_5": "CASE id % 12 WHEN 5 THEN 1.25 WHEN 6 THEN -0.5 ELSE team1_win_rate_last_5 END",
        "team2_avg_runs_scored_last_5": "CASE WHEN id % 12 IN (6, 7) THEN -1.0 ELSE team2_avg_runs_scored_last_5 END",
        "team2_avg_wickets_taken_last_5": "CASE id % 12 WHEN 8 THEN 10.5 WHEN 9 THEN -2.0 ELSE team2_avg_wickets_taken_last_5 END",
        "team1_avg_economy_rate_last_5": "CASE id % 12 WHEN 10 THEN -0.1 ELSE team1_avg_economy_rate_last_5 END"}
ALL_REQ = "allreq AS (SELECT * FROM req UNION ALL SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _BAD.items()) + ") FROM req WHERE id % 5 = 0)"
CHECKED = f"checked AS (SELECT *, {_violations()} AS violations FROM allreq)"
ORACLES["validate_requests"] = w(*FORM_CTES, FORM, REQ, ALL_REQ, CHECKED) + \
    "SELECT id, violations, CASE WHEN violations = '' THEN 1 ELSE 0 END AS is_valid FROM checked"

# scores by recent form: requests of one venue have an unknown label
_UNSEEN = "concat_ws(',', " + ", ".join(
    f"CASE WHEN coalesce({c} IN (SELECT {c} FROM req WHERE venue <> 'MACHINERY'), false) THEN NULL ELSE '{c}=' || coalesce({c}, '') END" for c in sorted(CATS)) + ")"
_FORM_P = "round((team1_win_rate_last_5 + 0.5) / (team1_win_rate_last_5 + 0.5 + team2_win_rate_last_5 + 0.5), 4)"
SCORED = f"""scored AS (SELECT *, CASE WHEN status = 'scored' THEN CAST(p >= 0.5 AS INTEGER) END AS predicted_winner_team1,
    CASE WHEN status = 'scored' THEN p END AS prediction_probability_team1 FROM (
  SELECT *, CASE WHEN violations <> '' THEN 'invalid' WHEN unseen <> '' THEN 'unseen_label' ELSE 'scored' END AS status,
    CASE WHEN violations <> '' THEN violations WHEN unseen <> '' THEN unseen END AS reason FROM (
    SELECT *, {_UNSEEN} AS unseen, {_FORM_P} AS p FROM checked) a) b)"""
SCORED_CTES = [*FORM_CTES, FORM, REQ, ALL_REQ, CHECKED, SCORED]
VIEW = """viewed AS (SELECT *, CASE predicted_winner_team1 WHEN 1 THEN team1 ELSE team2 END AS predicted_winner,
    round(CASE predicted_winner_team1 WHEN 1 THEN p ELSE 1 - p END * 100, 2) AS win_probability FROM scored WHERE status = 'scored')"""
ORACLES["score_status"] = w(*SCORED_CTES) + "SELECT id, status, reason, predicted_winner_team1, prediction_probability_team1 FROM scored"
ORACLES["prediction_view_of_form"] = w(*SCORED_CTES, VIEW) + "SELECT id, team1, team2, predicted_winner, win_probability FROM viewed"
ORACLES["predictions_json_of_form"] = w(*SCORED_CTES) + """SELECT id, CASE status WHEN 'scored'
  THEN '{"predicted_winner_team1":' || predicted_winner_team1 || ',"prediction_probability_team1":' || prediction_probability_team1 || '}'
  ELSE '{"status":"' || status || '","reason":"' || reason || '"}' END AS response FROM scored"""


def _prompt_sql() -> str:
    stats = ["win_rate_last_5", "avg_margin_last_5", "avg_runs_scored_last_5", "avg_wickets_taken_last_5", "avg_economy_rate_last_5"]
    args = [*CATS, "team1", *[f"team1_{s}" for s in stats], "team2", *[f"team2_{s}" for s in stats], "predicted_winner", "win_probability"]
    pieces = [x.replace("%%", "%").replace("'", "''") for x in text.PROMPT_TEMPLATE.split("%s")]
    filled = [f"'{pieces[0]}'"]
    for a, piece in zip(args, pieces[1:]):
        filled += [f"coalesce(CAST({a} AS VARCHAR), 'None')", f"'{piece}'"]
    return " || ".join(filled)


ORACLES["explanation_prompt_of_form"] = w(*SCORED_CTES, VIEW) + f"SELECT id, {_prompt_sql()} AS prompt FROM viewed"
RS = f"rs AS (SELECT *, CASE WHEN {hash_expr(42)} < {TEST_CUT} THEN 'test' ELSE 'train' END AS split FROM form)"
ORACLES["unseen_labels"] = w(*FORM_CTES, FORM, RS,
    "vocab AS (" + " UNION ".join(f"SELECT '{c}' AS col, {c} AS value FROM rs WHERE split = 'train' AND venue IS DISTINCT FROM 'MACHINERY' AND {c} IS NOT NULL"
                                  for c in CATS) + ")",
    "req AS (" + " UNION ALL ".join(f"SELECT id, '{c}' AS col, {c} AS value FROM rs"
                                    for c in CATS) + ")") + """SELECT id, col AS "column", value FROM req
WHERE NOT EXISTS (SELECT 1 FROM vocab v WHERE v.col = req.col AND v.value = req.value)"""
ORACLES["conform_schema"] = w(*FORM_CTES, FORM) + "SELECT id, " + ", ".join(CATS) + ", " + ", ".join(
    r6(c, c) for c in REQ_DOUBLES) + \
    ", 0 AS toss_winner_is_team1, 0 AS team1_bat_first, 0 AS team1_toss_bat_first, 0 AS team2_toss_bat_first FROM form"
ORACLES["table_profile"] = w(*BASE_P, CLEANED, FC) + """SELECT 'contests' AS "table", count(*) AS "rows", 11 AS "columns" FROM contests
UNION ALL SELECT 'plays', count(*), 13 FROM plays
UNION ALL SELECT 'cleaned', count(*), 11 FROM cleaned
UNION ALL SELECT 'form_contests', count(*), 11 FROM fc"""


def _markup_sql(col: str) -> str:
    # fixed values: markup rules in this order
    rules = [(r"\n\n", "</p><p>"), (r"\n", "<br>"), (r"\*\*(.*?)\*\*", r"<strong>\1</strong>"),
             (r"# (.*?)(?:\n|\z)", r'<h4 class="font-bold mt-4 mb-2">\1</h4>'),
             (r"## (.*?)(?:\n|\z)", r'<h5 class="font-bold mt-3 mb-2">\1</h5>')]
    e = col
    for pat, rep in rules:
        e = f"regexp_replace({e}, '{pat}', '{rep}', 'g')"
    return f"'<p>' || {e} || '</p>'"


ORACLES["markup_to_html"] = f"SELECT doc_id, {_markup_sql('text')} AS html FROM documents"

PM = f"pm AS ({PLAYER_MATCH})"
ROLL = "ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"
BR = f"""br AS (SELECT pm.match_id, pm.batter, pm.runs_scored, pm.balls_faced, c.date,
    pm.runs_scored / pm.balls_faced * 100 AS strike_rate,
    avg(pm.runs_scored) OVER w AS rolling_avg_runs,
    avg(pm.runs_scored / pm.balls_faced * 100) OVER w AS rolling_strike_rate,
    avg(pm.balls_faced) OVER w AS rolling_balls_faced
  FROM pm JOIN cleaned c ON c.id = pm.match_id
  WINDOW w AS (PARTITION BY pm.batter ORDER BY c.date, pm.match_id {ROLL}))"""
ORACLES["batter_rolling"] = w(*BASE_P, CLEANED, PM, BR) + "SELECT match_id, batter, date, " + ", ".join(
    r6(c, c) for c in ["rolling_avg_runs", "rolling_strike_rate", "rolling_balls_faced"]) + " FROM br"
ORACLES["bowler_rolling"] = w(*BASE_P, CLEANED, f"""bm AS (
  SELECT p.match_id, p.bowler, c.date, CAST(sum(p.is_wicket) AS BIGINT) AS wickets_taken,
    CAST(sum(p.total_runs) AS BIGINT) AS runs_conceded,
    count(*) - count(*) FILTER (WHERE p.wide_runs > 0 OR p.noball_runs > 0) AS legal_balls,
    count(*) / 6.0 AS overs_bowled
  FROM plays p JOIN cleaned c ON c.id = p.match_id WHERE p.bowler IS NOT NULL GROUP BY p.match_id, p.bowler, c.date)""",
    f"""bm2 AS (SELECT *, CASE WHEN legal_balls <> 0 THEN runs_conceded * 6.0 / legal_balls END AS economy_rate FROM bm)""") + \
    f"""SELECT match_id, bowler, date,
  {r6(f'avg(wickets_taken) OVER w', 'rolling_avg_wickets')}, {r6('avg(economy_rate) OVER w', 'rolling_economy')},
  {r6('avg(runs_conceded) OVER w', 'rolling_runs_conceded')}, {r6('avg(overs_bowled) OVER w', 'rolling_overs_bowled')}
FROM bm2 WINDOW w AS (PARTITION BY bowler ORDER BY date, match_id {ROLL})"""
CAREER = """career AS (SELECT batter, CAST(sum(batsman_runs) AS BIGINT) AS total_runs, count(match_id) AS balls_faced_career,
  count(*) FILTER (WHERE batsman_runs = 4) AS fours, count(*) FILTER (WHERE batsman_runs = 6) AS sixes,
  sum(batsman_runs) / count(match_id) * 100 AS strike_rate_career FROM plays WHERE batter IS NOT NULL GROUP BY batter)"""
PTS_ENC = [c for c in MOM_ENC_COLS if c not in ("id", "date")]
ORACLES["player_training_set"] = w(*MOMENTUM_CTES, MOM, ENC, PLAYS, PM, BR, CAREER) + "SELECT br.match_id, br.batter, " + \
    "br.runs_scored, br.balls_faced, br.date, " + ", ".join(
        r6(f"br.{c}", c) for c in ["strike_rate", "rolling_avg_runs", "rolling_strike_rate", "rolling_balls_faced"]) + ", " + \
    ", ".join(r6(f"e.{c}", c) if c in MOM_DOUBLES else f"e.{c}" for c in PTS_ENC) + \
    ", k.total_runs, k.balls_faced_career, k.fours, k.sixes, " + r6("k.strike_rate_career", "strike_rate_career") + """
FROM br LEFT JOIN enc e ON e.id = br.match_id LEFT JOIN career k ON k.batter = br.batter"""
ORACLES["safe_ratio"] = w(*BASE_P, BOWLING) + f"""SELECT match_id, team,
  {r6('CASE WHEN legal_balls_bowled <> 0 THEN runs_conceded * 6.0 / legal_balls_bowled END', 'ratio')},
  {r6('CASE WHEN legal_balls_bowled <> 0 THEN runs_conceded * 6.0 / legal_balls_bowled ELSE 0.0 END', 'ratio_or_zero')}
FROM bw"""
ORACLES["scan_requests"] = w(*FORM_CTES, FORM) + "SELECT " + ", ".join(CATS) + ", " + ", ".join(
    r6(c, c) for c in REQ_DOUBLES) + " FROM form"
ORACLES["write_tables"] = w(*BASE_P, CLEANED) + """SELECT 'team_stats' AS "table", count(*) AS "rows", 7 AS "columns"
  FROM (SELECT DISTINCT team FROM (SELECT team1 AS team FROM cleaned UNION ALL SELECT team2 FROM cleaned) t) x
UNION ALL SELECT 'venue_stats', count(DISTINCT venue), 5 FROM cleaned
UNION ALL SELECT 'batter_stats', count(DISTINCT batter), 6 FROM plays
UNION ALL SELECT 'bowler_stats', count(DISTINCT bowler), 5 FROM plays
UNION ALL SELECT 'player_match_stats', count(*), 4 FROM (SELECT DISTINCT match_id, batter FROM plays
  WHERE batter IS NOT NULL AND match_id IN (SELECT id FROM cleaned)) pm
UNION ALL SELECT 'contest_momentum', count(*), 24 FROM cleaned
UNION ALL SELECT 'contest_momentum_encoded', count(*), 24 FROM cleaned"""

# What is read back from a written table is what was written.
for _name, _same in {"team_stats": "team_career", "venue_stats": "venue_stats", "batter_stats": "batter_career", "bowler_stats": "bowler_career",
                     "player_match_stats": "player_match", "contest_momentum": "contest_momentum"}.items():
    ORACLES[f"stored_{_name}"] = ORACLES[_same]
ORACLES["form_table_roundtrip"] = ORACLES["contest_form"]
ORACLES["training_set_of_stored"] = ORACLES["training_set"]
