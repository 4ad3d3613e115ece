"""Exact quantiles without a task for each group."""

import random

import numpy as np
from pyspark.sql import functions as F

from faceoff.operators import explore


def test_quantiles_equal_numpy(spark):
    r = random.Random(4)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([1, 2, None]), r.choice([None, float(r.randrange(6)), r.random() * 9 - 4])) for _ in range(3000)]
    rows += [("one", 1, 7.5), ("none", 1, None), ("two", 1, 1.0), ("two", 1, 2.0)]
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(rows, "g string, t int, value double").repartition(5)
    got = {(x.g, x.t): (x.n, x.q) for x in explore.quantiles(df, ["g", "t"], probabilities).collect()}
    want = {}
    for g, t, v in rows:
        if v is not None:
            want.setdefault((g, t), []).append(v)
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k][0] == len(values) and np.allclose(got[k][1], np.quantile(values, probabilities), atol=1e-12)


def test_medians_and_box_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 0), (3.0, None, 0), (None, None, 1)], "a double, b double, t int")
    assert explore.medians(df, ["a", "b"]) == {"a": 2.0, "b": None} and explore.medians(df, []) == {}
    assert explore.median_impute(df, ["a", "b"]).where("a is null").count() == 0
    box = explore.box_stats(df, ["a", "b"], "t").collect()
    assert [(x.feature, x.t, x.q1, x.median, x.q3, x.n) for x in box] == [("a", 0, 1.5, 2.0, 2.5, 2)]
    assert explore.quantiles(df.limit(0).select(F.lit("x").alias("g"), F.col("a").alias("value")), ["g"], [0.5]).count() == 0


def test_no_percentile_and_no_keyless_aggregate_of_values(spark):
    df = spark.range(50).select(F.lit("x").alias("g"), F.col("id").cast("double").alias("value"))
    plan = explore.quantiles(df, ["g"], [0.5])._jdf.queryExecution().executedPlan().toString().lower()
    assert "percentile" not in plan and "singlepartition" not in plan
