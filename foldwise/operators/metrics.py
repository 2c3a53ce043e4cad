"""Classification metrics as grouped aggregations (one pass, map-side combined)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import clip
from foldwise.plans.joins import dim_join, persisted, stat_join
from foldwise.plans.ordered import running_sum

LOGLOSS_EPS = 1e-15


def threshold(prob: str = "prob", t: float = 0.5):
    """P20: class call ``prob >= t``."""
    return (F.col(prob) >= F.lit(t)).cast("int")


def classification_metrics(df: DataFrame, label: str = "label", pred: str | None = None,
                           prob: str | None = "prob", group_cols: Sequence[str] = (),
                           t: float = 0.5, eps: float = LOGLOSS_EPS) -> DataFrame:
    """X2 accuracy and F1, X3 clipped log loss, X5 Brier score per group."""
    y = F.col(label)
    p_hat = F.col(pred) if pred else threshold(prob, t)
    tp = F.sum(F.when((p_hat == 1) & (y == 1), 1).otherwise(0))
    fp = F.sum(F.when((p_hat == 1) & (y == 0), 1).otherwise(0))
    fn = F.sum(F.when((p_hat == 0) & (y == 1), 1).otherwise(0))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg((p_hat == y).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
    ]
    if prob:
        pc = clip(prob, eps, 1 - eps)
        aggs.append(F.avg(-(y * F.ln(pc) + (1 - y) * F.ln(1 - pc))).alias("logloss"))
        aggs.append(F.avg((F.col(prob) - y) ** 2).alias("brier"))
    return df.groupBy(*group_cols).agg(*aggs)


def confusion(df: DataFrame, label: str = "label", pred: str = "pred",
              group_cols: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*group_cols).agg(
        F.sum(((p == 1) & (y == 1)).cast("long")).alias("tp"),
        F.sum(((p == 1) & (y == 0)).cast("long")).alias("fp"),
        F.sum(((p == 0) & (y == 1)).cast("long")).alias("fn"),
        F.sum(((p == 0) & (y == 0)).cast("long")).alias("tn"),
    )


def auc(df: DataFrame, label: str = "label", score: str = "prob", group_cols: Sequence[str] = (),
        weight: str | None = None, out: str = "auc") -> DataFrame:
    """X4 ROC AUC with ties counted ½ (Mann-Whitney), per group; null when a group has one class.

    Rows are first reduced to distinct (group, score) with positive/negative counts, then negatives
    below each score come from the running sum — never a one-partition window.
    """
    group_cols = list(group_cols)
    w = F.col(weight) if weight else F.lit(1)
    y = F.col(label)
    glob = not group_cols
    d = df.select(*group_cols, score, label, *([weight] if weight else []))
    if glob:
        d, group_cols = d.withColumn("_fw_all", F.lit(0)), ["_fw_all"]
    dist = d.groupBy(*group_cols, score).agg(
        F.sum(F.when(y == 1, w).otherwise(0)).cast("double").alias("_p"),
        F.sum(F.when(y == 0, w).otherwise(0)).cast("double").alias("_n"))
    res = _area(dist, group_cols, score, out)
    return res.drop("_fw_all") if glob else res


def count_auc(df: DataFrame, score: str, pos: str, neg: str, group_cols: Sequence[str], out: str = "auc") -> DataFrame:
    """X4 over rows that stand for ``pos`` positives and ``neg`` negatives, per group."""
    dist = df.groupBy(*group_cols, score).agg(F.sum(pos).alias("_p"), F.sum(neg).alias("_n"))
    return _area(dist, list(group_cols), score, out)


def _area(dist: DataFrame, group_cols: list, score: str, out: str) -> DataFrame:
    dist = persisted(dist)
    cum = running_sum(dist, group_cols, [score], ["_n"])
    res = cum.groupBy(*group_cols).agg(
        F.sum(F.col("_p") * (F.col("cum__n") - F.col("_n") + 0.5 * F.col("_n"))).alias("_u"),
        F.sum("_p").alias("_np"), F.sum("_n").alias("_nn"))
    return res.select(*group_cols, F.try_divide(F.col("_u"), F.col("_np") * F.col("_nn")).alias(out),
                      F.col("_np").alias("n_pos"), F.col("_nn").alias("n_neg"))


def calibration_curve(df: DataFrame, label: str = "label", prob: str = "prob", n_bins: int = 10,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """X6 uniform-bin reliability table: bins right-closed, empty bins absent."""
    p = F.col(prob)
    b = sum((p > F.lit(i / n_bins)).cast("int") for i in range(1, n_bins))
    return (df.withColumn("bin", b).groupBy(*group_cols, "bin")
            .agg(F.avg(prob).alias("prob_pred"), F.avg(F.col(label).cast("double")).alias("prob_true"),
                 F.count(F.lit(1)).alias("n")))


def fold_summary(metrics: DataFrame, group_cols: Sequence[str], value: str,
                 sample: bool = False) -> DataFrame:
    """X11 mean and std over folds (population std by default, sample std for the notebooks)."""
    sd = F.stddev_samp if sample else F.stddev_pop
    return metrics.groupBy(*group_cols).agg(F.avg(value).alias(f"{value}_mean"),
                                            sd(value).alias(f"{value}_std"))


__all__ = ["auc", "calibration_curve", "classification_metrics", "confusion", "fold_summary",
           "threshold", "dim_join", "stat_join"]
