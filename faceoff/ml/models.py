"""Model jobs on Spark ML.

Training is distributed by Spark ML: tree learners aggregate split statistics
across partitions. All searches cover the whole grids, ``REFERENCE_*``, along nested
paths (:mod:`faceoff.ml.search`).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.ml import prep
from faceoff.ml.forest import Forest

MAX_DEPTH_CAP = 30  # the deepest tree Spark builds; 'unlimited' maps here

# Grids of the original jobs (depth None -> MAX_DEPTH_CAP; min_samples_split s -> minInstancesPerNode ceil(s/2)).
REFERENCE_RF_F1 = {"numTrees": [100, 200], "maxDepth": [10, 20, MAX_DEPTH_CAP], "minInstancesPerNode": [1, 3]}
REFERENCE_RF_ACC = {"numTrees": [100, 200], "maxDepth": [10, 20, MAX_DEPTH_CAP], "minInstancesPerNode": [1, 3],
                    "leaf": [1, 3], "weighted": [True, False]}
REFERENCE_GBT_ACC = {"maxIter": [100, 200], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1],
                     "subsamplingRate": [0.8, 1.0], "featureSubsetStrategy": ["0.8", "all"]}
REFERENCE_PLAYER = {"numTrees": [50, 100], "maxDepth": [MAX_DEPTH_CAP, 10, 20], "minInstancesPerNode": [1, 3],
                    "leaf": [1, 3]}


def with_balanced_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """'balanced' class weights n/(k·n_c) as a ``weight`` column (per-class table joined back)."""
    from faceoff.operators import explore
    w = explore.class_weights(df, label).select(F.col(label).alias("_wl"), F.col("balanced_weight").alias("weight"))
    return df.join(F.broadcast(w), F.col(label) == F.col("_wl"), "left").drop("_wl")  # one row per class


def node_sizes(grid: dict) -> dict[int, list[tuple[int, int]]]:
    """Least node size -> the (split, leaf) settings it stands for: both bound the size of a node,
    and Spark has one parameter for them."""
    out: dict[int, list[tuple[int, int]]] = {}
    for split in grid.get("minInstancesPerNode", [1]):
        for leaf in grid.get("leaf", [1]):
            out.setdefault(max(split, leaf), []).append((split, leaf))
    return dict(sorted(out.items()))


def fitted_grid(grid: dict) -> dict:
    """The settings that are fitted: settings of equal node size are fitted once."""
    spec = {k: v for k, v in grid.items() if k not in ("weighted", "leaf")}
    return spec | {"minInstancesPerNode": list(node_sizes(grid))} if "leaf" in grid else spec


# Performance settings for tree learners (no effect on the model): a larger
# per-pass node budget means fewer passes over the data for deep trees, and the
# node-id cache avoids re-walking each tree from the root at every level.
TREE_SPEED = {"maxMemoryInMB": 1024, "cacheNodeIds": True, "checkpointInterval": 10}


def bins(codes: int) -> int:
    """maxBins that gives every one of so many codes its own bin."""
    return max(64, codes + 1)


def rf_classifier(seed: int = 42) -> Forest:
    return Forest("classifier", seed)


def gbt_classifier(seed: int = 42) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", seed=seed, maxBins=64, **TREE_SPEED)


def importances(spark: SparkSession, model, features: list[str], k: int = 15) -> DataFrame:
    """Feature importances of a tree model, ranked (one value per feature)."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(k)


def rf_regressor(seed: int, depth: int = 15, trees: int = 100, min_inst: int = 3) -> Forest:
    return Forest("regressor", seed, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_inst)


def gbt_regressor(seed: int, iters: int = 100, depth: int = 7, step: float = 0.1) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="label", seed=seed, maxIter=iters, maxDepth=depth,
                        stepSize=step, maxBins=64, **TREE_SPEED)
