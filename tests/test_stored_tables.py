"""Feature tables with their spec, profiles of written tables, reports from two aggregates, streams and single fits."""

import pytest
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.ml import jobs, metrics, score
from faceoff.operators import aggregates
from faceoff.sources import features, sinks
from tests.test_served_model import form


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_roundtrip_and_checks(spark, tmp_path):
    d = spark.createDataFrame([(1, 2020, 0.5, "a"), (2, 2021, None, None)], "id long, season int, rate double, name string")
    path = features.write_features(d, str(tmp_path / "t"), {"rate": 8.0}, partition_by=["season"])
    back = features.read_features(spark, path, types={"rate": "double"})
    assert back.dtypes == d.dtypes and sorted(back.collect()) == sorted(d.collect())
    assert [r.rate for r in features.read_features(spark, path, ["id", "rate"], filled=True).orderBy("id").collect()] == [0.5, 8.0]
    assert features.read_features(spark, path, ["name", "id"]).columns == ["name", "id"]
    with pytest.raises(features.SpecError, match="no column odds"):
        features.read_features(spark, path, ["id", "odds"])
    with pytest.raises(features.SpecError, match="rate is double, not int"):
        features.read_features(spark, path, types={"rate": "int"})
    with pytest.raises(features.SpecError, match="absent columns: x"):
        features.write_features(d, str(tmp_path / "u"), {"x": 1.0})
    spark.createDataFrame([('{"version": 99}',)], "value string").write.mode("overwrite").text(f"{path}/spec")
    with pytest.raises(features.SpecError, match="layout 99"):
        features.read_features(spark, path)


def test_an_empty_feature_table_keeps_its_columns(spark, tmp_path):
    d = spark.createDataFrame([], "id long, rate double")
    assert features.read_features(spark, features.write_features(d, str(tmp_path / "e"))).dtypes == d.dtypes


def test_profile_reads_no_column(spark, tmp_path):
    tables = {"a": spark.range(7), "b": spark.range(0).withColumn("x", F.lit(1))}
    paths, profile = sinks.write_profiled(spark, tables, str(tmp_path))
    assert sorted(tuple(r) for r in profile.collect()) == [("a", 7, 1), ("b", 0, 2)]
    again = plan(sinks.write_profiled(spark, tables, str(tmp_path))[1])
    assert again.count("ReadSchema: struct<>") == again.count("ReadSchema") == 2 and spark.read.parquet(paths["a"]).count() == 7


def test_report_from_two_aggregates(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 0)]
    d = spark.createDataFrame(rows, "label int, prediction int")
    out = metrics.classification_report(d)
    got = {r.cls: r for r in out.collect()}
    assert set(got) == {"0", "1", "2", "macro avg", "weighted avg"} and got["weighted avg"].support == 11
    assert got["0"].recall == 5 / 7 and got["2"].f1 == 0 and abs(got["macro avg"].recall - (5 / 7 + 1 + 0) / 3) < 1e-12
    assert abs(got["weighted avg"].precision - (5 / 6 * 7 + 3 / 5 * 3) / 11) < 1e-12
    fresh = plan(metrics.classification_report(d))  # not run yet: one plan, not two
    assert fresh.count("Exchange hash") <= 2 and "Window" not in fresh
    named = spark.createDataFrame([("macro avg", "macro avg"), ("b", "macro avg")], "label string, prediction string")
    assert metrics.classification_report(named).count() == 4


def test_only_plays_of_the_latest_contests_are_summed(spark):
    long = spark.createDataFrame([("A", k, k) for k in range(9)], "team string, id long, date long")
    plays = spark.createDataFrame([(k, 1, "A", k) for k in range(9)], "match_id long, batter long, batting_team string, batsman_runs int")
    for side in ("both", "own"):
        out = aggregates.team_last_n_runs(long, plays, 5, side)
        assert [(r.team, r.avg_runs_last_n) for r in out.collect()] == [("A", 6.0)] and "LeftSemi" in plan(out)


def planted(spark, n=400):
    """The label follows one feature, scores follow another."""
    a = F.pmod(F.hash("id"), F.lit(100)) / 100
    b = F.pmod(F.hash(F.col("id") + 7), F.lit(50)).cast("double")
    return spark.range(n).select("id", a.alias("a"), b.alias("b"), (a > 0.6).cast("int").alias("team1_won"),
                                 (b * 3 + 100).cast("int").alias("winning_score"), (b + 50).cast("int").alias("losing_score"))


def test_single_fits_learn_what_is_there(spark):
    d = planted(spark)
    for report in (jobs.gbt_classifier(spark, d, iters=5, depth=2), jobs.rf_baseline(spark, d, trees=5)):
        assert all(r.value > 0.95 for r in report.collect() if r.metric == "test_accuracy")
    for kind in ("rf", "gbt"):
        for r in jobs.score_regressors(spark, d, kind, iters=5, trees=5).collect():
            assert r.metric != "test_mae" or r.value < (12 if "winning" in r.model else 5)


def test_stream_answers_every_request_like_the_batch(spark):
    d = form(spark, 60, 12)
    model = jobs.served_model(d, {"numTrees": [2], "maxDepth": [3], "minInstancesPerNode": [1]}, 2)
    batch = {r.id: tuple(r)[1:] for r in score.score_batch(model, jobs.requests(d)).collect()}
    stream = {r.id: (r.status, r.reason, r.predicted_winner_team1, r.prediction_probability_team1) for r in jobs.score_stream(spark, d, model).collect()}
    assert stream == batch and len(batch) == 60


def test_status_needs_no_model(spark):
    req = form(spark, 20, 5).select("id", *schemas.REQUEST_STRINGS, *schemas.REQUEST_DOUBLES)
    labels = {"venue": ["v000"], "team1": ["A"], "team2": ["B"], "toss_winner": ["A"], "toss_decision": ["bat"]}
    bad = req.limit(1).withColumns({"toss_decision": F.lit("bowl"), "id": F.lit(99).cast("long")})
    got = {r.id: r for r in score.recent_form_scores(req.unionByName(bad), labels).collect()}
    assert {r.status for i, r in got.items() if i % 5 == 0} == {"scored"} and got[1].reason == "venue=v001"
    assert got[99].status == "invalid" and got[99].prediction_probability_team1 is None
