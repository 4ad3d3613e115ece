"""The scoring queries serve the best forest of the grid, with balanced weights and a bin for each code."""

from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.ml import jobs, models, score


def form(spark, n=400, venues=100):
    """100 venues; one class has three quarters of the rows."""
    i = F.col("id")
    d = spark.range(n).select("id", F.format_string("v%03d", i % venues).alias("venue"), F.lit("A").alias("team1"), F.lit("B").alias("team2"),
                              F.lit("A").alias("toss_winner"), F.lit("bat").alias("toss_decision"))
    d = d.withColumns({c: (F.lit(1.0) + i % 3) / 4 for c in schemas.REQUEST_DOUBLES})
    return d.withColumns({"toss_winner_is_team1": F.lit(1), "team1_bat_first": F.lit(1), "team1_toss_bat_first": F.lit(1), "team2_toss_bat_first": F.lit(0),
                          "team1_won": ((i % venues) % 4 == 0).cast("int"), "winning_score": F.lit(1), "losing_score": F.lit(1)})


def test_best_parameters_weights_and_bins(spark):
    d = form(spark)
    model = jobs.served_model(d, {"numTrees": [3], "maxDepth": [7], "minInstancesPerNode": [2]}, 2)
    forest = model.stages[-1]
    assert (forest.getNumTrees, forest.getOrDefault("maxDepth"), forest.getOrDefault("minInstancesPerNode")) == (3, 7, 2)
    assert forest.getOrDefault("weightCol") == "weight" and forest.getOrDefault("maxBins") > 100
    assert {r.feature for r in score.importances(model).collect()} <= set(schemas.FORM_FEATURES)
    out = score.score_batch(model, jobs.requests(d))
    assert out.count() == out.where("status = 'scored'").count() == 400


def test_whole_grid_by_default():
    import inspect
    assert inspect.signature(jobs.served_model).parameters["grid"].default is models.REFERENCE_RF_F1
