"""Dictionary codes without a vocabulary in the driver; one shuffle of the rows in history operators."""

from pyspark.sql import functions as F

from faceoff.ml import prep
from faceoff.operators import form


def test_codes_of_many_labels(spark):
    n = 1_000_000
    d = spark.range(n).select(F.format_string("v%07d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("a"), F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("b"))
    out = prep.label_encode(d.withColumn("key", F.substring("a", 2, 7).cast("int")))
    wrong = out.where((F.col("a") != F.col("key")) | F.col("b").isNull())
    assert wrong.count() == 0 and out.count() == n
    assert {r.b for r in out.select("b").distinct().collect()} == {0, 1, 2}  # '1', '2', 'Unknown'


def test_codes_are_ranks_and_nulls_a_label(spark):
    d = spark.createDataFrame([("b", "x", "w"), ("a", None, "w"), (None, "é", "v"), ("B", "x", None)], "p string, q string, winner string")
    got = prep.label_encode(d).collect()
    assert [(r.p, r.q) for r in got] == [(3, 1), (2, 0), (1, 2), (0, 1)] and [r.winner for r in got] == ["w", "w", "v", None]
    assert prep.label_encode(d.limit(0)).count() == 0 and prep.label_encode(d.select("winner")).columns == ["winner"]


def exchanges(spark, df):
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return sum("Exchange hashpartitioning" in x and "Reused" not in x for x in plan.splitlines())


def test_rows_are_shuffled_once_for_all_steps(spark, tmp_path):
    d = spark.range(40).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).cast("string").alias("team"), F.expr("date_add(date'2020-01-01', int(id % 5))").alias("date"),
                               (F.col("id") % 3 - 1).cast("int").alias("outcome"), (F.col("id") % 2).cast("int").alias("won"))
    d.write.parquet(f"{tmp_path}/t")
    d = spark.read.parquet(f"{tmp_path}/t")
    # the rows, the columns that the days are made of, the days, and the days back to their rows
    assert exchanges(spark, form.streak_before(d)) <= 4
    assert exchanges(spark, form.repeat_count(d.withColumn("winner", F.col("won").cast("string")), "team", "winner")) <= 7
