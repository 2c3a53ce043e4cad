"""Estimator factories on Spark ML and readers of fitted-model internals.

The reference's learners map to Spark ML: L2 logistic regression behind a scaler, random forest,
three gradient-boosting configurations (depth-wise, leaf-count-limited, deeper "ordered" boosting)
and a two-hidden-layer rectifier network (``network``). Bit-for-bit agreement with other libraries is not expected;
every fit is a distributed Spark job and every factory accepts a ``weight`` column (D10).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.network import Network

FEATURES = "features"

# fixed values: default hyper-parameters of the five learners
DEFAULTS = {
    "logreg": dict(C=1.0, max_iter=1000),
    "random_forest": dict(n_estimators=500, max_depth=5, min_samples_leaf=3, max_features="sqrt", seed=42),
    "gbt_depthwise": dict(n_estimators=500, learning_rate=0.03, max_depth=3, subsample=0.8, seed=42),
    "gbt_leafwise": dict(n_estimators=500, learning_rate=0.03, num_leaves=15, subsample=0.8, seed=42),
    "gbt_ordered": dict(n_estimators=500, learning_rate=0.03, max_depth=6, subsample=0.8, seed=42),
    "mlp": dict(hidden=(64, 32), max_iter=500, learning_rate=0.001, alpha=0.001, seed=42),
}


def assembler(cols: Sequence[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def logistic(C: float = 1.0, n_rows: int | None = None, max_iter: int = 1000, label: str = "label",
             weight: str | None = None) -> Pipeline:
    """M1: standardise (mean and scale) then L2 logistic regression; sklearn's C maps to
    ``regParam = 1 / (C · n)`` because Spark averages the loss over rows."""
    reg = 1.0 / (C * n_rows) if n_rows else 1.0 / C
    scaler = StandardScaler(inputCol=FEATURES, outputCol="_scaled", withMean=True, withStd=True)
    lr = LogisticRegression(featuresCol="_scaled", labelCol=label, regParam=reg, elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, **({"weightCol": weight} if weight else {}))
    return Pipeline(stages=[scaler, lr])


def random_forest(n_estimators: int = 500, max_depth: int = 5, min_samples_leaf: int = 3,
                  max_features: str = "sqrt", seed: int = 42, label: str = "label",
                  weight: str | None = None) -> RandomForestClassifier:
    """M2."""
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=n_estimators, maxDepth=max_depth,
                                  minInstancesPerNode=min_samples_leaf, featureSubsetStrategy=max_features,
                                  seed=seed, **({"weightCol": weight} if weight else {}))


def gbt(n_estimators: int = 500, learning_rate: float = 0.03, max_depth: int = 3, subsample: float = 0.8,
        seed: int = 42, label: str = "label", weight: str | None = None, num_leaves: int | None = None) -> GBTClassifier:
    """M3 / M4 / M5: gradient-boosted trees. A leaf-count limit becomes the depth that holds it."""
    depth = max_depth if num_leaves is None else max(1, math.ceil(math.log2(num_leaves)))
    return GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=n_estimators, stepSize=learning_rate,
                         maxDepth=depth, subsamplingRate=subsample, seed=seed,
                         **({"weightCol": weight} if weight else {}))


def mlp(hidden: Sequence[int] = (64, 32), max_iter: int = 500, learning_rate: float = 0.001, alpha: float = 0.001,
        seed: int = 42, label: str = "label") -> Network:
    """M6: scaled inputs → rectified hidden layers → logit, early stopping. Its steps use all rows at once, so they
    are ten times as long as those of batches of 200 rows would be."""
    return Network(hidden, max_iter, 10 * learning_rate, alpha, seed=seed, features=FEATURES, label=label)


def factory(name: str, n_features: int, n_rows: int | None = None, label: str = "label",
            weight: str | None = None, **over):
    """Estimator by name with the default hyper-parameters, overridable."""
    p = {**DEFAULTS[name], **over}
    if name == "logreg":
        return logistic(p["C"], n_rows, p["max_iter"], label, weight)
    if name == "random_forest":
        return random_forest(p["n_estimators"], p["max_depth"], p["min_samples_leaf"], p["max_features"], p["seed"], label, weight)
    if name == "gbt_depthwise":
        return gbt(p["n_estimators"], p["learning_rate"], p["max_depth"], p["subsample"], p["seed"], label, weight)
    if name == "gbt_leafwise":
        return gbt(p["n_estimators"], p["learning_rate"], 3, p["subsample"], p["seed"], label, weight, num_leaves=p["num_leaves"])
    if name == "gbt_ordered":
        return gbt(p["n_estimators"], p["learning_rate"], p["max_depth"], p["subsample"], p["seed"], label, weight)
    if name == "mlp":
        if weight:
            raise ValueError("the multilayer perceptron takes no row weights")
        return mlp(p["hidden"], p["max_iter"], p["learning_rate"], p["alpha"], p["seed"], label)
    raise KeyError(name)


def positive_probability(pred: DataFrame, out: str = "prob") -> DataFrame:
    """P(class 1) from Spark ML's probability vector."""
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


def _last_stage(model):
    return model.stages[-1] if hasattr(model, "stages") else model


def feature_importance(spark: SparkSession, model, cols: Sequence[str]) -> DataFrame:
    """M7: split-based importances of a tree model as a table, largest first."""
    imp = _last_stage(model).featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(cols, imp)), "feature string, importance double")


def coefficients(spark: SparkSession, model, cols: Sequence[str]) -> DataFrame:
    """M8: logistic coefficients (on standardised inputs) with their magnitude."""
    coef = _last_stage(model).coefficients.toArray().tolist()
    return spark.createDataFrame([(c, float(v), abs(float(v))) for c, v in zip(cols, coef)],
                                 "feature string, coefficient double, magnitude double")


def loss_curve(spark: SparkSession, model, data: DataFrame | None = None) -> DataFrame:
    """M9: per-iteration training objective (logistic regression) or log loss (boosting; network: with the
    held-out rows' loss)."""
    last = _last_stage(model)
    if hasattr(last, "history"):
        rows = [(i, float(a), None if b is None else float(b)) for i, (a, b) in enumerate(last.history)]
        return spark.createDataFrame(rows, "iteration int, loss double, held_out_loss double")
    if hasattr(last, "summary") and hasattr(last.summary, "objectiveHistory"):
        hist = list(last.summary.objectiveHistory)
    elif hasattr(last, "evaluateEachIteration") and data is not None:
        hist = list(last.evaluateEachIteration(data))
    else:
        hist = []
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")
