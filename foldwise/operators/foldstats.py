"""Leave-fold-out statistics in one pass.

A statistic "for eval fold f" is computed on the training rows whose fold differs from f; eval fold
-1 means every training row (the final fit that scores the test side). Instead of recomputing per
fold, rows are aggregated once:

* counts, sums, min / max, mean / variance per (fold, group…): the small table of blocks is fanned out to
  the eval folds it trains (k-1 of them, plus -1) and combined, (n, mean, M2) by the parallel (Chan)
  formula — no sum-of-squares cancellation;
* quantiles / modes: one row per distinct value with a vector of counts (``value_vectors``), an eval fold's
  being all rows less its own; one running sum carries the vector, and no value is copied per fold.

Without a fold column everything is keyed by eval fold -1 only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.plans.ordered import vector_quantiles

EVAL = "eval_fold"
ALL_FOLDS = -1


def eval_targets(fold: Column, k: int) -> Column:
    """Array of eval folds a row of ``fold`` trains: every f != fold, plus -1."""
    return F.filter(F.array(*[F.lit(f) for f in range(-1, k)]), lambda f: f != fold)


def fan_out(df: DataFrame, fold_col: str | None, k: int | None) -> DataFrame:
    """Attach ``eval_fold`` (exploding small per-fold tables to the folds they train)."""
    if fold_col is None:
        return df.withColumn(EVAL, F.lit(ALL_FOLDS))
    return df.withColumn(EVAL, F.explode(eval_targets(F.col(fold_col), k)))


def moments(df: DataFrame, value: str, group_cols: Sequence[str], fold_col: str | None,
            k: int | None, prefix: str | None = None) -> DataFrame:
    """(eval_fold, group…) → n, mean, std_samp, std_pop, min, max, sum of ``value`` (nulls skipped)."""
    p = prefix if prefix is not None else f"{value}_"
    group_cols = list(group_cols)
    keys = ([fold_col] if fold_col else []) + group_cols
    v = F.col(value)
    per = df.where(v.isNotNull()).groupBy(*keys).agg(
        F.count(v).alias("_n"), F.avg(v).alias("_m"), (F.var_pop(v) * F.count(v)).alias("_m2"),
        F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.sum(v).alias("_s"))
    per = fan_out(per, fold_col, k)
    w = Window.partitionBy(EVAL, *group_cols)
    per = per.withColumn("_gm", F.sum(F.col("_n") * F.col("_m")).over(w) / F.sum("_n").over(w))
    out = per.groupBy(EVAL, *group_cols).agg(
        F.sum("_n").alias("_n"), F.first("_gm").alias("_mean"),
        (F.sum("_m2") + F.sum(F.col("_n") * (F.col("_m") - F.col("_gm")) ** 2)).alias("_M2"),
        F.min("_lo").alias(f"{p}min"), F.max("_hi").alias(f"{p}max"), F.sum("_s").alias(f"{p}sum"))
    return out.select(
        EVAL, *group_cols, F.col("_n").alias(f"{p}n"), F.col("_mean").alias(f"{p}mean"),
        F.sqrt(F.try_divide(F.col("_M2"), F.col("_n") - 1)).alias(f"{p}std"),
        F.sqrt(F.col("_M2") / F.col("_n")).alias(f"{p}std_pop"),
        f"{p}min", f"{p}max", f"{p}sum")


def eval_folds(k: int | None) -> list[int]:
    return [ALL_FOLDS] if k is None else [ALL_FOLDS, *range(k)]


def vector_columns(k: int | None) -> list[str]:
    """Columns of a count vector: the training rows of each entry of ``eval_folds``."""
    return [f"_n{e + 1}" for e in eval_folds(k)]


def vector_of(fold_col: str | None, k: int | None) -> list[Column]:
    """A row's own count vector: 1 for all rows, and for each eval fold but its own."""
    if fold_col is None:
        return [F.lit(1).cast("long").alias("_n0")]
    fold = F.col(fold_col)
    return [F.when(fold.isNotNull(), 1).otherwise(0).cast("long").alias("_n0"),
            *[F.when(fold != e, 1).otherwise(0).cast("long").alias(f"_n{e + 1}") for e in range(k)]]


def value_vectors(df: DataFrame, value: str, group_cols: Sequence[str], fold_col: str | None,
                  k: int | None) -> DataFrame:
    """(group…, value) → ``vector_columns``: a distinct value is one row whatever the number of folds."""
    rows = df.where(F.col(value).isNotNull()).select(*group_cols, value, *vector_of(fold_col, k))
    return rows.groupBy(*group_cols, value).agg(*[F.sum(c).alias(c) for c in vector_columns(k)])


def by_eval(vectors: DataFrame, keep: Sequence[str], k: int | None, count: str = "_fw_cnt") -> DataFrame:
    """One row per eval fold with a positive count. For tables of groups or categories, not of values."""
    entries = F.array(*[F.struct(F.lit(e).alias(EVAL), F.col(c).alias(count)) for e, c in zip(eval_folds(k), vector_columns(k))])
    return vectors.select(*keep, F.explode(entries).alias("_e")).select(*keep, "_e.*").where(F.col(count) > 0)


def fold_quantiles(df: DataFrame, value: str, group_cols: Sequence[str], qs: Sequence[float],
                   names: Sequence[str], fold_col: str | None, k: int | None) -> DataFrame:
    """(eval_fold, group…) → exact quantiles of the training rows: one running sum over the distinct values
    carries the counts of every eval fold."""
    vectors = value_vectors(df, value, group_cols, fold_col, k)
    return vector_quantiles(vectors, value, group_cols, qs, names, vector_columns(k), EVAL, eval_folds(k))


def fold_quantiles_multi(df: DataFrame, values: Sequence[str], group_cols: Sequence[str],
                         qs: Sequence[float], fold_col: str | None, k: int | None) -> DataFrame:
    """Quantiles of several columns in one pass: the columns are stacked to (_var, _val) so one
    distinct-value table and one running count serve all of them. Output columns ``{col}_q{NN}``
    (or ``{col}_median`` for q = .5 alone)."""
    values = list(values)
    stacked = df.select(*([fold_col] if fold_col else []), *group_cols,
                        F.explode(F.array(*[F.struct(F.lit(v).alias("_var"), F.col(v).cast("double").alias("_val"))
                                            for v in values])).alias("_s")).select(
        *([fold_col] if fold_col else []), *group_cols, "_s._var", "_s._val")
    names = [f"_q{i}" for i in range(len(qs))]
    q = fold_quantiles(stacked, "_val", ["_var", *group_cols], qs, names, fold_col, k)
    suffix = ["median"] if list(qs) == [0.5] else [f"q{int(round(x * 100)):02d}" for x in qs]
    aggs = [F.max(F.when(F.col("_var") == v, F.col(n))).alias(f"{v}_{sfx}")
            for v in values for n, sfx in zip(names, suffix)]
    return q.groupBy(EVAL, *group_cols).agg(*aggs)


def fold_mode(df: DataFrame, value: str, group_cols: Sequence[str], fold_col: str | None,
              k: int | None, out: str | None = None) -> DataFrame:
    """Most frequent non-null value per (eval_fold, group); ties → smallest value (pandas order)."""
    out = out or f"{value}_mode"
    vectors = value_vectors(df, value, group_cols, fold_col, k)
    best = vectors.groupBy(*group_cols).agg(*[
        F.min(F.when(F.col(c) > 0, F.struct((-F.col(c)).alias("c"), F.col(value).alias("v")))).alias(c) for c in vector_columns(k)])
    entries = F.array(*[F.struct(F.lit(e).alias(EVAL), F.col(c).alias("b")) for e, c in zip(eval_folds(k), vector_columns(k))])
    rows = best.select(*group_cols, F.explode(entries).alias("_e")).where(F.col("_e.b").isNotNull())
    return rows.select(f"_e.{EVAL}", *group_cols, F.col("_e.b.v").alias(out))


def fold_shares(df: DataFrame, value: str, fold_col: str | None, k: int | None,
                out: str | None = None) -> DataFrame:
    """Share of each non-null value among the non-null training rows (``value_counts(normalize)``)."""
    counts = by_eval(value_vectors(df, value, [], fold_col, k), [value], k)
    tot = counts.groupBy(EVAL).agg(F.sum("_fw_cnt").alias("_tot"))
    return counts.join(F.broadcast(tot), EVAL).select(
        EVAL, value, (F.col("_fw_cnt") / F.col("_tot")).alias(out or f"{value}_freq"))


def train_eval_frame(train: DataFrame, test: DataFrame | None, fold_col: str | None) -> DataFrame:
    """Rows to transform, each tagged with the eval fold whose statistics apply: training rows use
    their own fold (out-of-fold features), test rows use the full-train statistics (-1)."""
    tr = train.withColumn(EVAL, F.col(fold_col) if fold_col else F.lit(ALL_FOLDS))
    if test is None:
        return tr
    te = test.withColumn(EVAL, F.lit(ALL_FOLDS))
    return tr.unionByName(te, allowMissingColumns=True)
