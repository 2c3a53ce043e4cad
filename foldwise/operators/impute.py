"""Imputation and train statistics (fit on training rows, apply anywhere).

All fitted tables are keyed by ``eval_fold`` (see ``foldstats``); they are tiny (folds × groups) and
joined back behind a checked broadcast. Column names are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.foldstats import (EVAL, fold_mode, fold_quantiles, fold_quantiles_multi,
                                          fold_shares, moments)
from foldwise.functions.columns import clip
from foldwise.plans.joins import join_on_keys, persisted, stat_join
from foldwise.plans.ordered import exact_quantiles


# ---------------------------------------------------------------- I1: own-table statistics
def fill_from_own_table(df: DataFrame, median_cols: Sequence[str] = (), mode_cols: Sequence[str] = (),
                        mean_cols: Sequence[str] = ()) -> DataFrame:
    """Fill nulls with the table's own median / mode / mean (not leak-safe; never inside CV)."""
    stats = None
    if median_cols:
        q = fold_quantiles_multi(df, median_cols, [], [0.5], None, None)
        stats = q.select(*[F.col(f"{c}_median").alias(f"_med_{c}") for c in median_cols])
    for c in mode_cols:
        m = fold_mode(df, c, [], None, None, f"_mode_{c}").drop(EVAL)
        stats = m if stats is None else _one_row_join(stats, m)
    if mean_cols:
        m = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in mean_cols])
        stats = m if stats is None else _one_row_join(stats, m)
    if stats is None:
        return df
    out = _one_row_join(df, stats)
    fills = {c: f"_med_{c}" for c in median_cols}
    fills.update({c: f"_mode_{c}" for c in mode_cols})
    fills.update({c: f"_mean_{c}" for c in mean_cols})
    for c, s in fills.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(s)))
    return out.drop(*fills.values())


def _one_row_join(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row (equi-join on a constant key against a
    broadcast single row — size bounded by construction)."""
    k = "_fw_k"
    return df.withColumn(k, F.lit(0)).join(F.broadcast(one.withColumn(k, F.lit(0))), k).drop(k)


# ---------------------------------------------------------------- I2 / I3: group medians + mode
def fit_imputer(train: DataFrame, group_col: str, median_cols: Sequence[str], mode_cols: Sequence[str],
                fold_col: str | None = None, k: int | None = None):
    """Per-group medians, global medians and modes, keyed by eval fold.

    Returns (group_table, global_table)."""
    both = train.select(*([fold_col] if fold_col else []), *median_cols, F.explode(F.array(
        F.struct(F.lit(0).alias("_lvl"), F.col(group_col)), F.struct(F.lit(1).alias("_lvl"), F.lit(None).cast(train.schema[group_col].dataType).alias(group_col)))).alias("_s"))
    both = both.select("*", "_s.*").drop("_s")  # one running count serves the groups and the whole
    med = persisted(fold_quantiles_multi(both, median_cols, ["_lvl", group_col], [0.5], fold_col, k))
    g = med.where("_lvl = 0").drop("_lvl")
    glob = med.where("_lvl = 1").select(EVAL, *[F.col(f"{c}_median").alias(f"{c}_median_global") for c in median_cols])
    for c in mode_cols:
        m = fold_mode(train, c, [], fold_col, k, f"{c}_mode")
        glob = m if glob is None else glob.join(m, EVAL, "full_outer")
    return g, glob


def apply_imputer(df: DataFrame, group_tbl: DataFrame, global_tbl: DataFrame, group_col: str,
                  median_cols: Sequence[str], mode_cols: Sequence[str], checked: bool = True) -> DataFrame:
    """Value → group median → global median; category → mode. Expects ``eval_fold`` on ``df``.
    ``checked=False``: the caller knows that both tables may be broadcast."""
    out = join_on_keys(df, group_tbl, [EVAL, group_col], "left", checked=checked)
    out = join_on_keys(out, global_tbl, [EVAL], "left", checked=checked)
    for c in median_cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"{c}_median"), F.col(f"{c}_median_global")))
    for c in mode_cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"{c}_mode")))
    drop = [f"{c}_median" for c in median_cols] + [f"{c}_median_global" for c in median_cols]
    return out.drop(*drop, *[f"{c}_mode" for c in mode_cols])


# ---------------------------------------------------------------- I5 / I6: group statistics
def fit_group_stats(train: DataFrame, value: str, specs: Sequence[Sequence[str]],
                    fold_col: str | None = None, k: int | None = None) -> dict:
    """For each group spec: median, mean, sample std (null → 0); plus the global mean."""
    out = {}
    for spec in specs:
        spec = list(spec)
        mo = moments(train, value, spec, fold_col, k, prefix="_")
        med = fold_quantiles(train, value, spec, [0.5], ["_median"], fold_col, k)
        t = mo.join(med, [EVAL, *spec], "left").select(
            EVAL, *spec, F.col("_median").alias("median"), F.col("_mean").alias("mean"),
            F.coalesce(F.col("_std"), F.lit(0.0)).alias("std"))
        out[tuple(spec)] = t
    out["global"] = moments(train, value, [], fold_col, k, prefix="_").select(
        EVAL, F.col("_mean").alias("global_mean"))
    return out


def apply_group_stats(df: DataFrame, value: str, stats: dict) -> DataFrame:
    """``x - median`` and ``(x - mean)/sd``; unseen group → global mean, sd null or 0 → 1."""
    out = stat_join(df, stats["global"], [EVAL], "left")
    x = F.col(value)
    for spec, t in stats.items():
        if spec == "global":
            continue
        sfx = "_".join(spec)
        t = t.select(EVAL, *spec, F.col("median").alias("_g_med"), F.col("mean").alias("_g_mean"),
                     F.col("std").alias("_g_std"))
        out = stat_join(out, t, [EVAL, *spec], "left")
        med = F.coalesce(F.col("_g_med"), F.col("global_mean"))
        mean = F.coalesce(F.col("_g_mean"), F.col("global_mean"))
        sd = F.coalesce(F.col("_g_std"), F.lit(1.0))
        sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        out = (out.withColumn(f"{value}_diff_{sfx}", x - med)
               .withColumn(f"{value}_z_{sfx}", (x - mean) / sd)
               .drop("_g_med", "_g_mean", "_g_std"))
    return out.drop("global_mean")


# ---------------------------------------------------------------- I7: frequency encoding
def fit_frequency(train: DataFrame, col: str, fold_col: str | None = None, k: int | None = None):
    return fold_shares(train, col, fold_col, k, f"{col}_freq")


def apply_frequency(df: DataFrame, col: str, shares: DataFrame) -> DataFrame:
    """Share of the category among training rows; unseen → 0."""
    return stat_join(df, shares, [EVAL, col], "left").withColumn(
        f"{col}_freq", F.coalesce(F.col(f"{col}_freq"), F.lit(0.0)))


# ---------------------------------------------------------------- I8: min-max position in group
def fit_range(train: DataFrame, value: str, group_col: str, fold_col: str | None = None,
              k: int | None = None) -> DataFrame:
    return moments(train, value, [group_col], fold_col, k, prefix="_").select(
        EVAL, group_col, F.col("_min").alias("_lo"), F.col("_max").alias("_hi"))


def apply_range(df: DataFrame, value: str, group_col: str, rng: DataFrame, out: str) -> DataFrame:
    """I8: (x - lo)/(hi - lo) clipped to [0,1]; unseen group uses (0, 1); hi = lo → width 1."""
    j = stat_join(df, rng, [EVAL, group_col], "left")
    lo = F.coalesce(F.col("_lo"), F.lit(0.0))
    hi = F.coalesce(F.col("_hi"), F.lit(1.0))
    width = F.when(hi != lo, hi - lo).otherwise(F.lit(1.0))
    pos = (F.col(value) - lo) / width
    return j.withColumn(out, clip(pos, 0.0, 1.0)).drop("_lo", "_hi")


# ---------------------------------------------------------------- I9 / I10
def group_zscore(df: DataFrame, value: str, group_col: str, fit_on: DataFrame | None = None,
                 out: str | None = None) -> DataFrame:
    """Z-score inside the group; 0 unless the group has >1 row and sd > 0."""
    src = fit_on if fit_on is not None else df
    st = moments(src, value, [group_col], None, None, prefix="_").select(
        group_col, "_n", "_mean", "_std")
    j = stat_join(df, st, [group_col], "left")
    ok = (F.col("_n") > 1) & (F.col("_std") > 0)
    z = F.when(ok, (F.col(value) - F.col("_mean")) / F.col("_std")).otherwise(F.lit(0.0))
    return j.withColumn(out or f"{value}_group_z", z).drop("_n", "_mean", "_std")


def above_group_quantile(df: DataFrame, value: str, group_col: str, q: float = 0.75,
                         fit_on: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """1 when the value is strictly above the group's q-quantile."""
    src = fit_on if fit_on is not None else df
    qt = exact_quantiles(src, value, [group_col], [q], ["_gq"])
    j = stat_join(df, qt, [group_col], "left")
    return j.withColumn(out or f"{value}_above_q", F.coalesce((F.col(value) > F.col("_gq")).cast("int"),
                                                             F.lit(0))).drop("_gq")


__all__ = ["fill_from_own_table", "fit_imputer", "apply_imputer", "fit_group_stats",
           "apply_group_stats", "fit_frequency", "apply_frequency", "fit_range", "apply_range",
           "group_zscore", "above_group_quantile"]
