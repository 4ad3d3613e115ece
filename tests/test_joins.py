"""Contests meet plays by key: what the planner takes for a small file may hold millions of rows."""

import datetime as dt

import pytest

from faceoff import schemas
from faceoff.operators import aggregates, form
from faceoff.plans import players
from faceoff.sources import tables as sources


def tables(spark, tmp_path):
    day = dt.date(2020, 1, 1)
    c = spark.createDataFrame([(k, 2020, day, "A", "B", "V", "A", "bat", "A", "runs", 1.0) for k in range(20)], schemas.CONTEST)
    p = spark.createDataFrame([(k % 22, 1 + k % 2, k, k % 3, k % 4, "A", "B", 1, 1, 0, None, 0, 0) for k in range(60)],
                              "match_id long, inning int, ball int, batter long, bowler long, batting_team string, bowling_team string, "
                              "batsman_runs int, total_runs int, is_wicket int, player_dismissed long, wide_runs int, noball_runs int")
    c.write.parquet(f"{tmp_path}/c")
    p.write.parquet(f"{tmp_path}/p")
    return spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/p")


JOINS = {
    "player_match": aggregates.player_match,
    "contests_of_players": aggregates.contests_of_players,
    "plays_with_venue": aggregates.plays_with_venue,
    "bowler_match": lambda c, p: players.bowler_match(p, c),
}


@pytest.mark.parametrize("name", JOINS)
def test_contests_are_not_broadcast(spark, tmp_path, name):
    c, p = tables(spark, tmp_path)
    df = JOINS[name](c, p)
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() and df.where("match_id >= 20" if "match_id" in df.columns else "id >= 20").count() == 0


def test_rolling_tables_are_written_without_a_broadcast(spark, tmp_path, monkeypatch):
    c, p = tables(spark, tmp_path)
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(form, "materialize", kept)
    players.batter_rolling(aggregates.player_match(c, p), c)
    players.bowler_rolling(p, c)
    form.player_streak(c, p)
    assert len(plans) == 3 and not any("Broadcast" in x for x in plans)


def test_stand_in_tables_are_joined_by_key(spark, tmp_path):
    kinds = {"orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string",
             "customer": "c_custkey long, c_nationkey long, c_mktsegment string", "nation": "n_nationkey long, n_name string",
             "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"}
    rows = {"orders": [(1, 1, "F", "2020-01-01"), (2, 2, "O", "2020-01-02"), (3, 9, "P", "2020-01-03"), (4, None, "F", "2020-01-04")],
            "customer": [(1, 0, "S"), (2, 1, "S"), (2, 3, "T"), (None, 0, "U")], "nation": [(k, f"N{k}") for k in range(25)],
            "lineitem": [(1, 5, 6, 1, 3.0, "N", "O"), (2, 5, 6, 2, 3.0, "R", "F"), (7, 5, 6, 1, 3.0, "N", "O"), (None, 5, 6, 1, 3.0, "N", "O")]}
    for name, kind in kinds.items():
        spark.createDataFrame(rows[name], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    c = sources.testdata_contests(spark, str(tmp_path))
    p = sources.testdata_plays(spark, str(tmp_path), c)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    # of the contests' joins only the two with nation, 25 rows, are broadcasts
    assert (plan(c).count("SortMergeJoin"), plan(c).count("BroadcastHashJoin")) == (1, 2)
    assert (plan(p).count("SortMergeJoin"), plan(p).count("BroadcastHashJoin")) == (2, 2)
    assert sorted((r.id, r.venue) for r in c.collect()) == [(1, "S"), (2, "S"), (2, "T")]
    assert sorted(r.match_id for r in p.collect()) == [1, 2, 2]
