"""Readers and writers: CSV NA tokens, JSON request arrays, schema conformance."""

import pytest

from faceoff import schemas
from faceoff.sources import conform, tables


def test_csv_contests_by_header(spark, tmp_path):
    p = tmp_path / "matches.csv"
    p.write_text("id,league,date,winner,team2,team1,venue,toss_winner,toss_decision,result,result_margin\n"
                 "1,X,2020-04-01,,B,A,NA,A,bat,runs,10\n"
                 '2,Y,2021-05-02,B,A,B,"V, East",None,field,NA,oops\n')
    df = tables.read_contests(spark, str(p), "csv")
    assert df.columns == [f.name for f in schemas.CONTEST.fields]
    got = {r.id: r for r in df.collect()}
    assert (got[1].team1, got[1].team2, got[1].venue, got[1].winner, got[1].season) == ("A", "B", None, None, "2020")
    assert got[1].result_margin == 10.0 and got[2].result_margin is None and got[2].venue == "V, East"
    assert got[2].toss_winner is None and got[2].result is None and str(got[2].date) == "2021-05-02"


def test_csv_plays_aliases_names_and_missing_columns(spark, tmp_path):
    p = tmp_path / "deliveries.csv"
    p.write_text("match_id,inning,batting_team,bowling_team,over,batsman,bowler,runs,total_runs,is_wicket\n"
                 "1,1,A,B,0,SC Ganguly,P Kumar,4.0,5,0\n1,2,B,A,3,NA,Z,1,1,1\n")
    got = tables.read_plays(spark, str(p), "csv").orderBy("inning").collect()
    assert (got[0].batter, got[0].bowler, got[0].batsman_runs, got[0].total_runs, got[0].wide_runs) == ("SC Ganguly", "P Kumar", 4, 5, 0)
    assert got[1].batter is None and got[1].is_wicket == 1 and got[1].batting_team == "B" and got[1].ball is None


def test_missing_required_column_is_an_error(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("id,date,team1,team2\n1,2020-01-01,A,B\n")
    with pytest.raises(ValueError, match="winner"):
        tables.read_contests(spark, str(p), "csv")


def test_request_json_arrays_roundtrip(spark, tmp_path):
    from faceoff.ml import jobs
    rows = [(i, "V", "A", "B", "A", "bat", *([0.5, 1.0, 150.0, 5.0, 8.0] * 2)) for i in range(25)]
    cols = "id long, " + ", ".join(f"{c} string" for c in schemas.REQUEST_STRINGS) + ", " + \
        ", ".join(f"{c} double" for c in schemas.REQUEST_DOUBLES)
    req = spark.createDataFrame(rows, cols)
    path = str(tmp_path / "req")
    jobs.write_requests_json(req, path, rows_per_file=10)
    lines = [ln for f in (tmp_path / "req").glob("part-*") for ln in open(f).read().splitlines() if ln]
    assert len(lines) == 3 and all(ln.startswith("[") and ln.endswith("]") for ln in lines)
    back = tables.read_requests(spark, path)
    assert back.count() == 25 and back.columns == [f.name for f in schemas.REQUEST.fields]
    # a pretty-printed single array document (the sample file shape) reads in multiline mode
    doc = tmp_path / "sample.json"
    doc.write_text('[\n  {"venue": "V", "team1": "A", "team2": "B", "toss_winner": "A",\n'
                   '   "toss_decision": "bat"},\n  {"venue": "W", "team1": "B", "team2": "A",\n'
                   '   "toss_winner": "A", "toss_decision": "field"}\n]\n')
    assert tables.read_requests(spark, str(doc), multiline=True).count() == 2


def test_conform_schema_adds_missing_with_default(spark):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    out, missing = conform.conform_schema(df, ["b", "c", "a"], defaults={"c": 7})
    assert out.columns == ["b", "c", "a"] and missing == ["c"]
    assert out.first().c == 7
