"""A1, A3, A4: agreement-gated pseudo labels and within-class mixup.

Mixup partners and mixing weights come from md5 hash uniforms (so DuckDB can reproduce every
synthetic row): each class numbers its rows in hash order (a bucketed running count), draws are a
small (class × n_aug) table of partner positions, and partner rows are fetched with an equi-join on
(class, position) — never a pairing of all rows of a class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import HASH_SCALE
from foldwise.operators.folds import assign_folds
from foldwise.plans.joins import join_on_keys

JOHNK_TRIES = 64


def pseudo_labels(scores: DataFrame, thresholds: Sequence[float], id_col: str = "id",
                  prob: str = "prob") -> DataFrame:
    """A1: for every threshold t, rows where all models say > t or all say < 1 − t; the pseudo label
    is ``mean > 0.5``."""
    agg = scores.groupBy(id_col).agg(F.min(prob).alias("p_min"), F.max(prob).alias("p_max"),
                                     F.avg(prob).alias("p_mean"))
    t = F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold")
    e = agg.select("*", t)
    keep = (F.col("p_min") > F.col("threshold")) | (F.col("p_max") < 1.0 - F.col("threshold"))
    return e.where(keep).select("threshold", id_col, (F.col("p_mean") > 0.5).cast("int").alias("pseudo_label"), "p_mean")


def _u(*parts) -> Column:
    """Hash uniform of a composite key built from literals and columns."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(HASH_SCALE)


def johnk_beta(alpha: float, *key) -> Column:
    """Beta(α, α) draw by Jöhnk's method from hash uniforms: the first of ``JOHNK_TRIES`` tries
    with X + Y ≤ 1 (X = U^(1/α), Y = V^(1/α)) gives X / (X + Y). At most every second try fails for
    α ≤ 1, so that none is accepted (→ 0.5) has a chance below 2^-64; a larger α is refused."""
    if not 0.0 < alpha <= 1.0:
        raise ValueError(f"alpha must lie in (0, 1], not {alpha}: Jöhnk's method accepts too few tries beyond")
    tries = F.transform(F.sequence(F.lit(0), F.lit(JOHNK_TRIES - 1)), lambda t: F.struct(
        F.pow(_u(*key, t, "u"), F.lit(1.0 / alpha)).alias("x"),
        F.pow(_u(*key, t, "v"), F.lit(1.0 / alpha)).alias("y")))
    ok = F.filter(tries, lambda s: (s["x"] + s["y"] <= 1.0) & (s["x"] + s["y"] > 0.0))
    first = F.element_at(ok, 1)
    return F.when(F.size(ok) > 0, first["x"] / (first["x"] + first["y"])).otherwise(F.lit(0.5))


def class_positions(df: DataFrame, feature_cols: Sequence[str], label: str = "label", id_col: str = "id",
                    seed: int = 42, group_cols: Sequence[str] = ()) -> DataFrame:
    """The rows numbered in hash order inside their (group…, class): the same for every ``n_aug`` and α."""
    g = list(group_cols)
    if g:  # one class key per (group…, label)
        df = df.withColumn("_cls", F.concat_ws("|", *[F.col(c).cast("string") for c in g], F.col(label).cast("string")))
    else:
        df = df.withColumn("_cls", F.col(label).cast("string"))
    return assign_folds(df.select(id_col, "_cls", label, *g, *feature_cols), "_cls", id_col, k=1 << 62,
                        seed=f"mix{seed}", out="pos")


def mixup(df: DataFrame, feature_cols: Sequence[str], label: str = "label", id_col: str = "id",
          n_aug: int = 100, alpha: float = 0.2, seed: int = 42, group_cols: Sequence[str] = (),
          positions: DataFrame | None = None) -> DataFrame:
    """A3: ``n_aug`` synthetic rows per class, x = λ·x_i + (1 − λ)·x_j with i ≠ j drawn uniformly
    inside the class and λ ~ Beta(α, α). ``group_cols`` (e.g. an eval fold) repeat the procedure
    inside every group in the same job. ``positions``: the ``class_positions`` of ``df``, where several calls share them."""
    g = list(group_cols)
    pos = class_positions(df, feature_cols, label, id_col, seed, g) if positions is None else positions
    sizes = pos.groupBy("_cls", label, *g).agg(F.count(F.lit(1)).alias("n_class")).where(F.col("n_class") >= 2)
    draws = sizes.select("_cls", label, *g, "n_class", F.explode(F.sequence(F.lit(0), F.lit(n_aug - 1))).alias("draw"))
    key = (seed, F.col("_cls"), F.col("draw"))
    i = F.floor(_u(*key, "i") * F.col("n_class")).cast("long")
    j0 = F.floor(_u(*key, "j") * (F.col("n_class") - 1)).cast("long")
    draws = draws.select("_cls", label, *g, "draw", i.alias("pi"), F.when(j0 >= i, j0 + 1).otherwise(j0).alias("pj"),
                         johnk_beta(alpha, *key).alias("lam"))
    # draws: classes × n_aug rows (a parameter): checked broadcast against the numbered rows
    ri = pos.select("_cls", F.col("pos").alias("pi"), *[F.col(c).alias(f"_i_{c}") for c in feature_cols])
    rj = pos.select("_cls", F.col("pos").alias("pj"), *[F.col(c).alias(f"_j_{c}") for c in feature_cols])
    j = join_on_keys(ri, draws, ["_cls", "pi"], "inner", checked=True)
    j = join_on_keys(rj, j, ["_cls", "pj"], "inner", checked=True)
    lam = F.col("lam")
    return j.select(*g, label, "draw", "lam", *[(lam * F.col(f"_i_{c}") + (1.0 - lam) * F.col(f"_j_{c}")).alias(c)
                                                for c in feature_cols])


def augmentation_summary(original: DataFrame, augmented: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: mean and std per feature, original vs augmented, and the differences."""
    def stats(df, sfx):
        one = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols])
        return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias(f"mean_{sfx}"),
                                                       F.col(f"s_{c}").alias(f"std_{sfx}")) for c in cols])).alias("s")).select("s.*")
    j = stats(original, "orig").join(stats(augmented, "aug"), "column")
    return j.withColumn("mean_diff", F.col("mean_aug") - F.col("mean_orig")).withColumn(
        "std_diff", F.col("std_aug") - F.col("std_orig"))
