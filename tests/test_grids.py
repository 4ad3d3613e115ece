"""The searches run the whole grids, and the report names every combination."""

import inspect

from pyspark.sql import functions as F

from faceoff.ml import jobs, models


def test_whole_grids_by_default():
    assert not [n for n in dir(models) if n.startswith("QUICK")]
    for job, grid, combinations in ((jobs.cv_rf_f1, models.REFERENCE_RF_F1, 12), (jobs.cv_rf_accuracy, models.REFERENCE_RF_ACC, 48),
                                    (jobs.cv_gbt_accuracy, models.REFERENCE_GBT_ACC, 48), (jobs.player_model, models.REFERENCE_PLAYER, 24)):
        assert inspect.signature(job).parameters["grid"].default is grid
        n = 1
        for values in grid.values():
            n *= len(values)
        assert n == combinations


def rows(spark):
    return spark.range(120).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
                                   (F.col("id") % 2).cast("int").alias("team1_won"), F.lit(1).alias("winning_score"), F.lit(1).alias("losing_score"))


def test_merged_combinations_are_listed(spark):
    grid = {"numTrees": [2], "maxDepth": [2], "minInstancesPerNode": [1, 3], "leaf": [1, 3], "weighted": [True, False]}
    got = [r for r in jobs.cv_rf_accuracy(spark, rows(spark), grid, 2).collect() if r.metric == "cv_accuracy"]
    assert len({r.params for r in got}) == len(got) == 8
    merged = {r.value for r in got if "weighted=True" in r.params and "minInstancesPerNode=3" in r.params}
    assert len(merged) == 1
    players = rows(spark).select(F.col("id").alias("match_id"), "a", "b", F.col("id").alias("batter"), F.lit(1).alias("balls_faced"))
    del grid["weighted"]
    got = [r for r in jobs.player_model(spark, players, "a", ["b"], "balls_faced", grid, 2).collect() if r.metric == "cv_mse"]
    assert len({r.params for r in got}) == len(got) == 4
