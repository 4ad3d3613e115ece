"""Plan shape checks, ML preparation, scoring, and an sf0.001 oracle smoke test."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
BAD_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
def test_core_plans_have_no_cross_join_or_python(spark):
    from faceoff.registry import QUERIES
    for key in ["contest_momentum", "contest_form", "recent_form", "batter_rolling", "bowler_rolling", "h2h_prior",
                "team_career", "venue_stats", "player_streak", "streak_current", "team_last_n_runs",
                "player_recent_form", "split_stratified", "team_match_stats"]:
        p = plan(QUERIES[key](spark, SF))
        for bad in BAD_NODES:
            assert bad not in p, (key, bad)


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
def test_entry_and_oracles_small(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
    con = duckdb.connect()
    for t in ["orders", "customer", "nation", "lineitem", "documents"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    Q, O = E.queries(), E.oracle_sql()
    assert set(O) <= set(Q)
    for key in ["last5_wins", "streak_before", "recent_form", "team_match_stats", "venue_stats", "h2h_prior",
                "split_stratified", "classification_report", "markup_to_html"]:
        a = Q[key](spark, SF).toPandas()
        b = con.execute(O[key]).df()
        assert sorted(a.columns) == sorted(b.columns), key
        assert len(a) == len(b), key
        cols = sorted(a.columns)
        def norm(df):
            rows = [tuple(None if (isinstance(v, float) and v != v) else (round(v, 6) if isinstance(v, float) else v)
                          for v in r) for r in df[cols].itertuples(index=False)]
            return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))
        assert norm(a) == norm(b), key


def test_split_stratified_exact_and_deterministic(spark):
    from faceoff.ml import prep
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    s1 = prep.split_stratified(df, "y").select("id", "split")
    s2 = prep.split_stratified(df.repartition(7), "y").select("id", "split")
    assert sorted(s1.collect()) == sorted(s2.collect())
    counts = {(r.y, r.split): r["count"] for r in prep.split_stratified(df, "y").groupBy("y", "split").count().collect()}
    assert counts[(1, "test")] == round(334 * 0.2) and counts[(0, "test")] == round(666 * 0.2)


def test_label_encode_alphabetical(spark):
    from faceoff.ml import prep
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "t string, x int")
    got = {r.x: r.t for r in prep.label_encode(df).collect()}
    assert got == {1: 2, 2: 1, 3: 0, 4: 3}  # code-point order: Unknown < a < b < c


def test_metrics(spark):
    from faceoff.ml import metrics
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)], "y int, p int")
    m = metrics.classification_metrics(df, "y", "p").first()
    assert (m.n, m.accuracy, m.precision, m.recall) == (5, 0.6, 2 / 3, 2 / 3)
    rep = {r.cls: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rep["0"].support == 2 and rep["weighted avg"].support == 5
    r = metrics.regression_metrics(spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, p double"), "y", "p").first()
    assert (r.mae, r.mse) == (1.5, 2.5)


def test_scoring_unseen_invalid_and_roundtrip(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from faceoff import schemas
    from faceoff.ml import score
    rows = []
    for i in range(60):
        t1, t2 = ("A", "B") if i % 2 else ("B", "C")
        rows.append((i, "V", t1, t2, t1, "bat" if i % 3 else "field", *([0.5, 1.0, 150.0, 5.0, 8.0] * 2), i % 2))
    cols = "id long, " + ", ".join(f"{c} string" for c in schemas.REQUEST_STRINGS) + ", " + \
        ", ".join(f"{c} double" for c in schemas.REQUEST_DOUBLES) + ", team1_won int"
    train = spark.createDataFrame(rows, cols)
    model = score.fit_scoring_model(train, trees=5, depth=3)
    req = spark.createDataFrame([(100, "V", "A", "B", "A", "bat", *([0.5, 1.0, 150.0, 5.0, 8.0] * 2)),
                                 (101, "Nowhere", "A", "B", "A", "bat", *([0.5, 1.0, 150.0, 5.0, 8.0] * 2)),
                                 (102, "V", "A", "B", "A", "sleep", *([1.5, 1.0, 150.0, 5.0, 8.0] * 2))],
                                cols.rsplit(", team1_won", 1)[0])
    out = {r.id: r for r in score.score_batch(model, req).collect()}
    assert out[100].status == "scored" and 0.0 <= out[100].prediction_probability_team1 <= 1.0
    assert out[101].status == "unseen_label" and out[101].reason == "venue=Nowhere"
    assert out[102].status == "invalid" and "toss_decision_invalid" in out[102].reason
    odd = req.drop("id").unionByName(req.drop("id").limit(1).withColumn("team2", F.lit(None).cast("string")))
    statuses = sorted(r.status for r in score.score_batch(model, odd).collect())
    assert statuses == ["invalid", "invalid", "scored", "unseen_label"]
    answers = {r.id: r.response for r in score.predictions_json(score.score_batch(model, req)).collect()}
    assert "venue=Nowhere" in answers[101] and "predicted_winner_team1" in answers[100]
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = {r.id: r for r in score.score_batch(PipelineModel.load(path), req).collect()}
    assert again[100].prediction_probability_team1 == out[100].prediction_probability_team1
