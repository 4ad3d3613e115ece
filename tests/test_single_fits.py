"""The single fits report what the best prediction from one binary feature gives on the test rows, worked out apart."""

import pytest
from pyspark.sql import functions as F

from faceoff.ml import jobs, prep


@pytest.fixture(scope="module")
def table(spark):
    """``x`` is 0 or 1; of the rows with x = 1 three in ten are won, of the others none; the scores
    are two levels and a spread around them."""
    i = F.col("id")
    d = spark.range(1200).withColumn("x", (i % 2).cast("double"))
    spread = (i * 7919 % 31).cast("double") - 15
    d = d.withColumns({"team1_won": ((F.col("x") == 1) & (i * 31 % 20 < 6)).cast("int"),
                       "winning_score": 150 + 40 * F.col("x") + spread, "losing_score": 120 - 30 * F.col("x") + spread})
    return prep.materialize(d)


def values(report):
    return {(r.model, r.metric): r.value for r in report.collect()}


def split(table, label, stratified, seed):
    s = prep.split_stratified(table, label, seed=seed) if stratified else prep.split_random(table, seed=seed)
    rows = [(r.split, r.x, r[label]) for r in s.select("split", "x", label).collect()]
    return [(x, y) for s, x, y in rows if s == "train"], [(x, y) for s, x, y in rows if s == "test"]


def test_weighted_boosting_finds_the_rare_class(spark, table):
    got = values(jobs.gbt_classifier(spark, table, iters=5, depth=2))
    train, test = split(table, "team1_won", True, 42)
    assert 0.1 < sum(y for _, y in train) / len(train) < 0.2
    hits = sum(1 for x, y in test if x == y == 1)
    precision, recall = hits / sum(x for x, _ in test), hits / sum(y for _, y in test)
    # weighted by neg / pos a row with x = 1 is rather won than not; without weights none would be
    assert got["gbt_weighted", "test_accuracy"] == pytest.approx(sum(x == y for x, y in test) / len(test))
    assert got["gbt_weighted", "test_f1"] == pytest.approx(2 * precision * recall / (precision + recall))


def test_plain_forest_keeps_to_the_majority(spark, table):
    got = values(jobs.rf_baseline(spark, table, trees=5))
    _, test = split(table, "team1_won", False, 42)
    assert got["rf_baseline", "test_accuracy"] == pytest.approx(sum(y == 0 for _, y in test) / len(test))
    assert got["rf_baseline", "test_f1"] == 0


@pytest.mark.parametrize("kind,near", [("gbt", 1e-6), ("rf", 0.03)])
def test_score_regressors_predict_the_means(spark, table, kind, near):
    got = values(jobs.score_regressors(spark, table, kind, iters=3, trees=10))
    for label, seed in (("winning_score", 123), ("losing_score", 456)):
        train, test = split(table, label, False, seed)
        of = {v: [y for x, y in train if x == v] for v in (0.0, 1.0)}
        mean = {v: sum(ys) / len(ys) for v, ys in of.items()}
        errors = [y - mean[x] for x, y in test]
        assert got[f"{kind}_{label}", "test_mae"] == pytest.approx(sum(map(abs, errors)) / len(errors), rel=near)
        assert got[f"{kind}_{label}", "test_rmse"] == pytest.approx((sum(e * e for e in errors) / len(errors)) ** 0.5, rel=near)
