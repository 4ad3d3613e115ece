"""End-to-end model jobs returning small report tables (M5-M13, M17, M19, S6, ST1).

Each job reads a training table produced by the feature plans, fits Spark ML
models (distributed) or searches a grid over all rows (:mod:`faceoff.ml.search`), evaluates on a hash split with the aggregate metrics of
:mod:`faceoff.ml.metrics`, and returns a tidy ``(model, params, metric, value)``
table. Only fitted parameters, tables of at most ``search.FIT_ROWS`` rows and metric scalars pass through the driver.
"""

from __future__ import annotations

import math
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.ml import metrics, models, prep, score, search
from faceoff.operators import clean
from faceoff.session import ensure_checkpoint_dir

REPORT = "model string, params string, metric string, value double"


def _report(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(m, p, k, float(v) if v is not None else None) for m, p, k, v in rows], REPORT)


def spark_cores(spark: SparkSession) -> int:
    """How many tasks run at once: a small table is dealt over so many, or one core does all."""
    return spark.sparkContext.defaultParallelism


def _params(setting: search.Setting, size: int, depth: int) -> dict:
    """The names of the grid and their values for one combination."""
    if setting.kind == "boosting":
        share = "all" if setting.features_share == 1 else str(setting.features_share)
        return {"featureSubsetStrategy": share, "maxDepth": setting.depth, "maxIter": size, "stepSize": setting.step,
                "subsamplingRate": setting.rows_share}
    return {"maxDepth": depth, "minInstancesPerNode": setting.least, "numTrees": size}


def _named(setting: search.Setting, size: int, depth: int, grid: dict) -> str:
    tag = f"weighted={setting.weighted}, " if "weighted" in grid else ""
    return tag + ", ".join(f"{k}={v}" for k, v in _params(setting, size, depth).items())


def _grid_rows(name: str, values: dict, settings: list, metric: str, grid: dict) -> list[tuple]:
    """A row for every combination of ``grid``; those of one node size share a fit and its value."""
    rows = []
    sizes = models.node_sizes(grid) if "leaf" in grid else {}
    for (k, size, depth), value in sorted(values.items()):
        p = _named(settings[k], size, depth, grid)
        merged = [f"{p}, split={a}, leaf={b}" for a, b in sizes.get(settings[k].least, [])]
        rows += [(name, q, f"cv_{metric}", value) for q in merged or [p]]
    return rows


def _test_rows(name: str, params: str, pred: DataFrame) -> list[tuple]:
    m = metrics.classification_metrics(pred, "label", "prediction").first()
    return [(name, params, "test_accuracy", m["accuracy"]), (name, params, "test_f1", m["f1"])]


def _split(ts: DataFrame, label: str, stratified: bool, seed: int):
    """(train, test, features): imputed, written once."""
    feats = prep.feature_columns(ts)
    ts = prep.impute_features(ts, feats)
    s = prep.materialize(prep.split_stratified(ts, label, seed=seed) if stratified else prep.split_random(ts, seed=seed))
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"), feats


def _search_classifier(spark: SparkSession, name: str, ts: DataFrame, settings: list, sizes: list[int], depths: list[int],
                       folds: int, metric: str, grid: dict, seed: int = 42) -> DataFrame:
    train, test, feats = _split(ts, "team1_won", True, seed)
    values, best, sample = search.search(train, feats, "team1_won", settings, sizes, depths, folds, metric, seed=seed)
    setting, size, depth = settings[best[0]], best[1], best[2]
    chosen = search.fit_chosen(spark, sample, feats, setting, size, depth, seed)
    rows = _grid_rows(name, values, settings, metric, grid)
    return _report(spark, rows + _test_rows(name, _named(setting, size, depth, grid), chosen.transform(test, "team1_won")))


def cv_rf_f1(spark: SparkSession, ts: DataFrame, grid=models.REFERENCE_RF_F1, folds: int = 5) -> DataFrame:
    """M5: forest grid with balanced class weights, k-fold CV on F1 of class 1."""
    settings = search.forest_settings("classifier", grid | {"weighted": [True]})
    return _search_classifier(spark, "rf_f1", ts, settings, grid["numTrees"], grid["maxDepth"], folds, "f1", grid)


def cv_rf_accuracy(spark: SparkSession, ts: DataFrame, grid=models.REFERENCE_RF_ACC, folds: int = 3) -> DataFrame:
    """M6: forest grid on accuracy; class weighting on/off is a grid dimension."""
    settings = search.forest_settings("classifier", models.fitted_grid(grid) | {"weighted": grid.get("weighted", [False])})
    return _search_classifier(spark, "rf_accuracy", ts, settings, grid["numTrees"], grid["maxDepth"], folds, "accuracy", grid)


def cv_gbt_accuracy(spark: SparkSession, ts: DataFrame, grid=models.REFERENCE_GBT_ACC, folds: int = 3) -> DataFrame:
    """M7: boosted-tree grid (iterations, depth, step, row and column sampling) on accuracy."""
    return _search_classifier(spark, "gbt_accuracy", ts, search.boosting_settings(grid), grid["maxIter"], grid["maxDepth"], folds, "accuracy", grid)


def _train_test(ts: DataFrame, label: str, stratified: bool, seed: int):
    """(train, test, features) in vectors; ``train`` is dealt over all cores, which read it many times."""
    train, test, feats = _split(ts, label, stratified, seed)
    train = prep.materialize(train.repartition(spark_cores(ts.sparkSession)))
    return prep.assemble(train, feats, label), prep.assemble(test, feats, label), feats


def gbt_classifier(spark: SparkSession, ts: DataFrame, iters: int = 100, depth: int = 6, step: float = 0.3) -> DataFrame:
    """M8: boosted trees with the positive class weighted by neg/pos of the train split."""
    from faceoff.operators import explore
    train, test, _ = _train_test(ts, "team1_won", True, 42)
    w = explore.class_weights(train, "label").select(F.col("label").alias("_l"), "scale_pos_weight")
    train = (train.join(F.broadcast(w), F.col("label") == F.col("_l"), "left")  # one row per class
             .withColumn("weight", F.when(F.col("label") == 1, F.col("scale_pos_weight")).otherwise(F.lit(1.0)))
             .drop("_l", "scale_pos_weight"))
    est = models.gbt_classifier().setMaxIter(iters).setMaxDepth(depth).setStepSize(step).setWeightCol("weight")
    pred = est.fit(train).transform(test)
    return _report(spark, _test_rows("gbt_weighted", f"maxIter={iters}, maxDepth={depth}, stepSize={step}", pred))


def _regression_rows(name: str, params: str, pred: DataFrame) -> list[tuple]:
    m = metrics.regression_metrics(pred, "label", "prediction").first()
    return [(name, params, "test_mae", m["mae"]), (name, params, "test_rmse", m["rmse"])]


def score_regressors(spark: SparkSession, ts: DataFrame, kind: str = "rf", iters: int = 100,
                     trees: int = 100) -> DataFrame:
    """Winning and losing score regressors (seeds 123 / 456), test MAE."""
    rows = []
    for target, seed in (("winning_score", 123), ("losing_score", 456)):
        train, test, _ = _train_test(ts, target, False, seed)
        if kind == "rf":
            est, params = models.rf_regressor(seed, trees=trees), f"numTrees={trees}, maxDepth=15, minInstancesPerNode=3"
        else:
            est, params = models.gbt_regressor(seed, iters=iters), f"maxIter={iters}, maxDepth=7, stepSize=0.1"
        pred = est.fit(train).transform(test)
        rows += _regression_rows(f"{kind}_{target}", params, pred)
    return _report(spark, rows)


def rf_baseline(spark: SparkSession, ts: DataFrame, trees: int = 100) -> DataFrame:
    """Plain forest with default settings (depth unlimited, as far as Spark goes) on a random split."""
    train, test, _ = _train_test(ts, "team1_won", False, 42)
    pred = models.rf_classifier().setNumTrees(trees).setMaxDepth(models.MAX_DEPTH_CAP).fit(train).transform(test)
    return _report(spark, _test_rows("rf_baseline", f"numTrees={trees}", pred))


def player_model(spark: SparkSession, data: DataFrame, target: str, features: list[str], exposure: str,
                 grid=models.REFERENCE_PLAYER, folds: int = 3, name: str = "player") -> DataFrame:
    """Forest regressor grid with k-fold CV on MSE; test MAE and CV RMSE (= sqrt best MSE)."""
    player = [c for c in ("batter", "bowler") if c in data.columns]
    # other columns aren't carried through the joins that make the table
    written = prep.materialize(clean.finite_only(data.select(*dict.fromkeys(["match_id", *player, target, *features, exposure]))))
    d = clean.require_columns(written, [target] + features)
    d = clean.positive_exposure(d, (exposure,))
    d = d.withColumn("_key", F.concat_ws(":", "match_id", *player))
    s = prep.split_random(d, key="_key", seed=42)
    s = prep.materialize(s)
    prep.discard(written)
    train, test = (s.filter(F.col("split") == x) for x in ("train", "test"))
    settings = search.forest_settings("regressor", models.fitted_grid(grid))
    values, best, sample = search.search(train, features, target, settings, grid["numTrees"], grid["maxDepth"], folds, "mse", key="_key")
    setting, size, depth = settings[best[0]], best[1], best[2]
    pred = search.fit_chosen(spark, sample, features, setting, size, depth, 42).transform(test, target)
    rows = _grid_rows(name, values, settings, "mse", grid)
    m = metrics.regression_metrics(pred, "label", "prediction").first()
    params = _named(setting, size, depth, grid)
    rows += [(name, params, "test_mae", m["mae"]), (name, params, "cv_rmse", math.sqrt(values[best]))]
    return _report(spark, rows)


# --- scoring -----------------------------------------------------------------------------

def served_model(form: DataFrame, grid=models.REFERENCE_RF_F1, folds: int = 5, seed: int = 42) -> PipelineModel:
    """M5 + S6: the scoring pipeline with the best parameters of the forest grid (F1, balanced class
    weights), fitted on the stratified train split that the grid was searched on."""
    form = prep.materialize(form)
    train, _, feats = _split(prep.training_set(form), "team1_won", True, seed)
    settings = search.forest_settings("classifier", grid | {"weighted": [True]})
    _, (k, size, depth), rows = search.search(train, feats, "team1_won", settings, grid["numTrees"], grid["maxDepth"], folds, "f1", seed=seed)
    search.forget(rows)
    train = prep.materialize(prep.split_stratified(form, "team1_won", seed=seed)).filter(F.col("split") == "train")
    train = prep.materialize(train.repartition(spark_cores(form.sparkSession)))
    return score.fit_scoring_model(train, size, depth, settings[k].least, seed)


def requests(form: DataFrame) -> DataFrame:
    """Every contest as a request."""
    return prep.materialize(form.select("id", *schemas.REQUEST_STRINGS, *schemas.REQUEST_DOUBLES))


def model_roundtrip(spark: SparkSession, form: DataFrame, model: PipelineModel) -> DataFrame:
    """Save the fitted pipeline (encoders, column order, forest) and load it back; compare scores."""
    req = requests(form)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/faceoff-model-{uuid.uuid4().hex[:12]}"
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = score.score_batch(model, req).select("id", F.col("prediction_probability_team1").alias("p_saved"))
    b = score.score_batch(loaded, req).select("id", F.col("prediction_probability_team1").alias("p_loaded"))
    return a.join(b, "id").withColumn("same", F.col("p_saved").eqNullSafe(F.col("p_loaded")).cast("int"))


def write_requests_json(req: DataFrame, path: str, rows_per_file: int = 10000) -> str:
    """Request batch as JSON arrays of objects (the request sample format), one array per line.

    Rows are spread over ``ceil(n / rows_per_file)`` arrays by a hash of the id,
    so each array is bounded; read back with ``read_requests`` (line mode).
    """
    n = req.count()
    files = max(1, math.ceil(n / rows_per_file))
    body = F.to_json(F.collect_list(F.struct(*req.columns)))
    (req.groupBy((F.pmod(F.xxhash64("id"), F.lit(files))).alias("_f")).agg(body.alias("value"))
        .select("value").write.mode("overwrite").text(path))
    return path


def score_stream(spark: SparkSession, form: DataFrame, model: PipelineModel) -> DataFrame:
    """ST1: requests dropped as JSON files are scored by a streaming query (available-now trigger)."""
    from faceoff.streaming.score_stream import start_scoring_stream
    req = requests(form)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/faceoff-stream-{uuid.uuid4().hex[:12]}"
    write_requests_json(req, f"{base}/in")
    q = start_scoring_stream(spark, f"{base}/in", model, f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
