"""Level-wise gradient-boosted trees by MLlib, the plainer form of M5 and M7.

MLlib's ``GBTRegressor`` has squared loss, shrinkage, row subsampling per
tree, feature subsampling, minimum rows per leaf and 64 bins, but grows
level-wise to ``maxDepth`` (leaf count maps to depth = ceil(log2(leaves))),
has no L1/L2 leaf penalty, gives its first tree weight 1, and can't go on from
a saved model.  The registered queries use ``operators.leafwise``.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast import schema as S
from tripcast.operators.leafwise import DEFAULT_PARAMS


def assemble(df: DataFrame, features: list[str] = S.FEATURE_COLUMNS, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


def depth_for_leaves(num_leaves: int) -> int:
    """Level-wise depth holding ``num_leaves`` leaves."""
    return max(1, math.ceil(math.log2(max(2, num_leaves))))


def gbt_estimator(params: dict | None = None, max_iter: int | None = None,
                  seed: int = 42, label: str = "label", prediction: str = "log_correction") -> GBTRegressor:
    """M5: the booster estimator for a parameter dict in the reference's
    vocabulary (stepSize / num_leaves / max_bin / min_data_in_leaf / ...)."""
    p = dict(DEFAULT_PARAMS)
    p.update(params or {})
    return GBTRegressor(featuresCol="features", labelCol=label, predictionCol=prediction,
                        maxIter=max_iter or p["num_boost_round"], stepSize=p["stepSize"],
                        maxDepth=depth_for_leaves(p["num_leaves"]),
                        maxBins=p["max_bin"] + 1, minInstancesPerNode=p["min_data_in_leaf"],
                        featureSubsetStrategy=str(p["feature_fraction"]),
                        subsamplingRate=p["bagging_fraction"], lossType="squared", seed=seed,
                        # trees are at most depth 8: node-id caching (and its
                        # checkpoints) costs more than it saves; a larger
                        # per-pass node budget means fewer passes per level
                        cacheNodeIds=False, maxMemoryInMB=512)


def best_prefix(model, valid: DataFrame) -> tuple[int, list[float]]:
    """M7: validation loss after each tree; the best prefix length (first
    minimum) -- early stopping with patience >= rounds only picks the best."""
    losses = list(model.evaluateEachIteration(valid, "squared"))
    best = min(range(len(losses)), key=lambda i: (losses[i], i)) + 1
    return best, losses


def predict_prefix(model, df: DataFrame, n_trees: int, out_col: str = "log_correction") -> DataFrame:
    """Prediction of the first ``n_trees`` trees of a fitted GBT model."""
    trees, weights = model.trees[:n_trees], model.treeWeights[:n_trees]
    total = F.lit(0.0)
    for i, (t, w) in enumerate(zip(trees, weights)):
        df = t.copy().setPredictionCol(f"_t{i}").transform(df)
        total = total + F.lit(w) * F.col(f"_t{i}")
    return df.withColumn(out_col, total).drop(*[f"_t{i}" for i in range(len(trees))])
