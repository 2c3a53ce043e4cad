"""T1e-T5e: target encoders, fitted per eval fold in one pass (sum and count are additive)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.foldstats import EVAL, fan_out
from foldwise.plans.joins import join_on_keys


def fit_target_stats(train: DataFrame, keys: Sequence[str], label: str = "label",
                     fold_col: str | None = None, k: int | None = None):
    """(eval_fold, keys…) → _te_s (label sum), _te_n (count); and (eval_fold) → _te_g (label mean).

    Null keys form their own group (the reference keys on the string form of the columns)."""
    keys = list(keys)
    fk = [fold_col] if fold_col else []
    per = train.groupBy(*fk, *keys).agg(F.sum(label).cast("double").alias("_s"),
                                        F.count(F.lit(1)).alias("_n"))
    per = fan_out(per, fold_col, k)
    stats = per.groupBy(EVAL, *keys).agg(F.sum("_s").alias("_te_s"), F.sum("_n").alias("_te_n"))
    glob = per.groupBy(EVAL).agg((F.sum("_s") / F.sum("_n")).alias("_te_g"))
    return stats, glob


def _attach(df, stats, glob, keys):
    out = join_on_keys(df, glob, [EVAL], "left", checked=False)  # one row per eval fold
    return join_on_keys(out, stats, [EVAL, *keys], "left", null_safe=True)


def loo_encode(train_rows: DataFrame, stats, glob, keys: Sequence[str], label: str, m: float,
               out: str) -> DataFrame:
    """T1e: (S − y + m·g)/(n − 1 + m) for training rows (their own label left out)."""
    j = _attach(train_rows, stats, glob, list(keys))
    enc = ((F.col("_te_s") - F.col(label) + F.lit(m) * F.col("_te_g"))
           / (F.col("_te_n") - 1 + F.lit(m)))
    return j.withColumn(out, enc).drop("_te_s", "_te_n", "_te_g")


def mestimate_encode(rows: DataFrame, stats, glob, keys: Sequence[str], m: float, out: str) -> DataFrame:
    """T2e: (S + m·g)/(n + m); a key unseen in training → g."""
    j = _attach(rows, stats, glob, list(keys))
    enc = F.coalesce((F.col("_te_s") + F.lit(m) * F.col("_te_g")) / (F.col("_te_n") + F.lit(m)),
                     F.col("_te_g"))
    return j.withColumn(out, enc).drop("_te_s", "_te_n", "_te_g")


def mestimate_sweep(rows: DataFrame, stats, glob, keys: Sequence[str], ms: Sequence[float],
                    out: str = "te") -> DataFrame:
    """T4e: the m-estimate for every m of a grid at once (the grid is a column, not a loop)."""
    j = _attach(rows, stats, glob, list(keys))
    j = j.withColumn("m", F.explode(F.array(*[F.lit(float(m)) for m in ms])))
    enc = F.coalesce((F.col("_te_s") + F.col("m") * F.col("_te_g")) / (F.col("_te_n") + F.col("m")),
                     F.col("_te_g"))
    return j.withColumn(out, enc).drop("_te_s", "_te_n", "_te_g")
