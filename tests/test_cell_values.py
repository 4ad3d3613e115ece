"""What a whole cell shares is computed once a cell."""

import datetime as dt

from faceoff.operators import form, timeline
from pyspark.sql import functions as F

LONG = "id long, side int, team string, date date, won int, signed_margin double, runs_scored long, wickets_taken long, economy_rate double"


def long_table(spark):
    day = dt.date(2020, 1, 1)
    return spark.createDataFrame([(k, 1, "AB"[k % 2], day + dt.timedelta(k // 6), k % 3 % 2, float(k), 100 + k, k % 9, None if k % 4 else 7.5)
                                  for k in range(60)], LONG)


def test_recent_values_are_not_computed_on_rows(spark):
    lt = long_table(spark)
    for df in (form.last_n_wins(lt), form.recent_form(lt)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "aggregate(" not in plan.split("Join")[0]


def test_values_equal_those_of_the_array(spark):
    lt = long_table(spark)
    values = {"n": F.size("_prior"), "last": F.get("_prior", F.size("_prior") - 1)["w"]}
    for strict in (True, False):
        args = (lt, "team", "date", "id", 5, {"w": F.col("won")}, strict)
        want = timeline.prior_rows(*args).withColumns(values).drop("_prior")
        got = timeline.prior_rows(*args, values=values)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
        assert got.where("n = 0").count() == 6 if strict else got.where("n = 0").count() == 2
