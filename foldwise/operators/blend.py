"""Ensembling over score columns.

Scores live in a long table (id, model, prob[, seed, fold]); ``wide`` pivots it to one column per
model. Search over blend weights never loops over Spark jobs: a weight grid is a literal list
exploded over the *distinct* tuples of the scores it blends, with their positives and negatives.
Where every point's AUC is asked for, one grouped, weighted AUC scores them all in the same job
(``pair_grid_auc``), or the points' scores are ranked as arrays (``grid_auc``, ``ranked``). Where only the best are (``grid_top``), counts in score buckets bound
each point's AUC first, then counts in more buckets that of the points left, and only points whose upper bound
reaches the k-th lower bound are scored exactly.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.columns import clip, logit, sigmoid
from foldwise.operators.metrics import count_auc
from foldwise.operators.ranked import blend_aucs
from foldwise.plans.joins import dim_join, persisted
from foldwise.plans.ordered import average_rank


def wide(scores: DataFrame, models: Sequence[str], keys: Sequence[str] = ("id", "label"),
         model: str = "model", prob: str = "prob", more: Mapping[str, str] | None = None) -> DataFrame:
    """One column per model (fixed order), and one with the prefix of ``more`` (prefix: column) for each of its columns.
    One aggregation, so the rows of a key that lie together are combined before they are shuffled."""
    return scores.groupBy(*keys).agg(*[F.first(F.when(F.col(model) == m, F.col(c)), ignorenulls=True).alias(f"{prefix}{m}")
                                       for prefix, c in {"": prob, **(more or {})}.items() for m in models])


def mean_expr(cols: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """N1 / N2 on wide columns, summed in a fixed order: Σ w·p / Σ w."""
    if weights is None:
        s = F.col(cols[0])
        for c in cols[1:]:
            s = s + F.col(c)
        return s / float(len(cols))
    s = F.lit(float(weights[0])) * F.col(cols[0])
    for w, c in zip(weights[1:], cols[1:]):
        s = s + F.lit(float(w)) * F.col(c)
    return s / F.lit(float(sum(weights)))


def soft_vote(scores: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "id",
              model: str = "model", prob: str = "prob", out: str = "prob") -> DataFrame:
    """N1 / N2 / N10 on the long table: (weighted) mean probability per id."""
    if not weights:
        return scores.groupBy(id_col).agg(F.avg(prob).alias(out))
    pairs = []
    for k, v in weights.items():
        pairs += [F.lit(k), F.lit(float(v))]
    w = F.create_map(*pairs)[F.col(model)]
    return (scores.withColumn("_w", w).where(F.col("_w").isNotNull()).groupBy(id_col)
            .agg((F.sum(F.col("_w") * F.col(prob)) / F.sum("_w")).alias(out)))


def percentile_ranks(scores: DataFrame, group_cols: Sequence[str] = ("model",), prob: str = "prob",
                     out: str = "rank_pct") -> DataFrame:
    """``rank(method='average') / n`` within each model (and fold)."""
    return average_rank(scores, list(group_cols), prob, out="_avg_rank", pct=out).drop("_avg_rank")


def logit_blend(cols: Sequence[str], eps: float = 0.001) -> Column:
    """Mean of clipped logits, mapped back with the sigmoid."""
    s = logit(cols[0], eps)
    for c in cols[1:]:
        s = s + logit(c, eps)
    return sigmoid(s / float(len(cols)))


def simplex_grid(k: int, step: float) -> list[tuple[float, ...]]:
    """Every weight vector on the k-simplex with the given step (N13: k=3, .05 → 231 points)."""
    n = int(round(1 / step))
    pts = []
    for combo in itertools.product(range(n + 1), repeat=k - 1):
        if sum(combo) <= n:
            ws = tuple(c * step for c in combo)
            pts.append(ws + (max(1.0 - sum(ws), 0.0),))
    return pts


def refine_grid(best: Sequence[float], step: float, radius: float) -> list[tuple[float, ...]]:
    """Finer grid around a point; weights clamped at 0 and renormalised to sum 1."""
    k = len(best)
    n = int(round(radius / step))
    pts = set()
    for d in itertools.product(range(-n, n + 1), repeat=k - 1):
        w = [max(best[i] + d[i] * step, 0.0) for i in range(k - 1)]
        last = max(1.0 - sum(w), 0.0)
        tot = sum(w) + last
        if tot <= 0:
            continue
        pts.add(tuple(round(x / tot, 12) for x in w + [last]))
    return sorted(pts)


def score_tuples(wide_df: DataFrame, cols: Sequence[str], label: str = "label",
                 extra_keys: Sequence[str] = ()) -> DataFrame:
    """(extra keys…, cols…) → _tp, _tn: the positives and negatives that share all scores of ``cols``."""
    y = F.col(label)
    return wide_df.groupBy(*extra_keys, *cols).agg(
        F.count(F.when(y == 1, 1)).cast("double").alias("_tp"), F.count(F.when(y == 0, 1)).cast("double").alias("_tn"))


def _on_grid(tuples: DataFrame, cols: Sequence[str], grid: Mapping[int, Sequence[float]],
             extra_keys: Sequence[str], more: Mapping[int, Sequence[float]] | None = None) -> DataFrame:
    """``tuples`` for every grid point, with its blended _score (and the floats of ``more`` as x0, x1 …)."""
    more = more or {g: () for g in grid}
    arr = F.array(*[F.struct(F.lit(int(g)).alias("grid_id"), *[F.lit(float(w)).alias(f"w{i}") for i, w in enumerate(ws)],
                             *[F.lit(float(x)).alias(f"x{i}") for i, x in enumerate(more[g])]) for g, ws in grid.items()])
    e = tuples.select("*", F.explode(arr).alias("_g")).select(*extra_keys, *cols, "_tp", "_tn", "_g.*")
    s = F.col("w0") * F.col(cols[0])
    for i, c in enumerate(cols[1:], 1):
        s = s + F.col(f"w{i}") * F.col(c)
    return e.withColumn("_score", s)


def _grid_table(df: DataFrame, grid: Mapping[int, Sequence[float]], k: int) -> DataFrame:
    return df.sparkSession.createDataFrame([(int(g), *[float(w) for w in ws]) for g, ws in grid.items()],
                                           "grid_id int, " + ", ".join(f"w{i} double" for i in range(k)))


def _exact(tuples: DataFrame, cols: Sequence[str], grid: Mapping[int, Sequence[float]], extra_keys: Sequence[str]) -> DataFrame:
    res = count_auc(_on_grid(tuples, cols, grid, extra_keys), "_score", "_tp", "_tn", [*extra_keys, "grid_id"])
    return dim_join(res.select(*extra_keys, "grid_id", "auc"), _grid_table(tuples, grid, len(cols)), ["grid_id"], "inner")


def grid_auc(wide_df: DataFrame, cols: Sequence[str], grid: Sequence[Sequence[float]],
             label: str = "label", extra_keys: Sequence[str] = ()) -> DataFrame:
    """AUC of Σ w_i·col_i for every weight vector of ``grid`` (N18/N21/H4); without extra keys no row is made for a tuple
    and point (``ranked``)."""
    cols, extra_keys, points = list(cols), list(extra_keys), dict(enumerate(grid))
    tuples = score_tuples(wide_df, cols, label, extra_keys)
    if extra_keys:
        return _exact(tuples, cols, points, extra_keys)
    res = blend_aucs(persisted(tuples), cols, points, "_tp", "_tn")
    return dim_join(res, _grid_table(tuples, points, len(cols)), ["grid_id"], "inner")


def auc_bounds(tuples: DataFrame, cols: Sequence[str], grid: Mapping[int, Sequence[float]],
               extra_keys: Sequence[str] = (), buckets: int = 512) -> DataFrame:
    """(extra keys…, grid_id) → lo, hi: bounds of each point's AUC from counts in equal score buckets. A
    positive beats the negatives of lower buckets for certain, and those of its own bucket perhaps."""
    cols, extra_keys = list(cols), list(extra_keys)
    ends = tuples.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in cols for f in (F.min, F.max)]).first()

    def reach(ws):  # the least and the widest blend of a point
        spans = [sorted((w * (ends[f"min_{c}"] or 0.0), w * (ends[f"max_{c}"] or 0.0))) for w, c in zip(ws, cols)]
        low, high = sum(x for x, _ in spans), sum(x for _, x in spans)
        return low, buckets / (high - low) if high > low else 0.0

    e = _on_grid(tuples, cols, grid, extra_keys, {g: reach(ws) for g, ws in grid.items()})
    # rounding may move a score to the next bucket, but never past an equal or a higher one
    bucket = F.floor((F.col("_score") - F.col("x0")) * F.col("x1")).cast("int")
    per = e.groupBy(*extra_keys, "grid_id", bucket.alias("_b")).agg(F.sum("_tp").alias("p"), F.sum("_tn").alias("n"))
    below = Window.partitionBy(*extra_keys, "grid_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # the buckets
    per = per.withColumn("_below", F.coalesce(F.sum("n").over(below), F.lit(0.0)))
    u = per.groupBy(*extra_keys, "grid_id").agg(F.sum(F.col("p") * F.col("_below")).alias("sure"), F.sum(F.col("p") * F.col("n")).alias("open"),
                                                (F.sum("p") * F.sum("n")).alias("all"))
    return u.select(*extra_keys, "grid_id", F.try_divide("sure", "all").alias("lo"), F.try_divide(F.col("sure") + F.col("open"), F.col("all")).alias("hi"))


def grid_top(wide_df: DataFrame, cols: Sequence[str], grid: Sequence[Sequence[float]], k: int,
             label: str = "label", extra_keys: Sequence[str] = (), always: Sequence[int] = (), buckets: int = 512, rounds: int = 2) -> DataFrame:
    """The ``k`` points of highest AUC (by 9 decimals, then by grid_id) per extra key, and the
    points ``always``, with their exact AUC: branch and bound, in ``rounds`` with 16 times as many ``buckets`` each.
    The driver sees two numbers a point and round."""
    cols, extra_keys = list(cols), list(extra_keys)
    points = dict(enumerate(grid))
    tuples = persisted(score_tuples(wide_df, cols, label, extra_keys))
    for n in (buckets * 16**i for i in range(rounds)):
        if len(points) <= k + len(always):
            break
        by_key: dict = {}
        for r in auc_bounds(tuples, cols, points, extra_keys, n).collect():
            by_key.setdefault(tuple(r[c] for c in extra_keys), []).append((r["grid_id"], r["lo"], r["hi"]))
        alive = set(always)
        for rows in by_key.values():
            if any(lo is None for _, lo, _ in rows):  # one class only: no AUC to compare
                alive |= {g for g, _, _ in rows}
                continue
            least = sorted((lo for _, lo, _ in rows), reverse=True)[min(k, len(rows)) - 1]
            alive |= {g for g, _, hi in rows if hi >= least - 1e-8}
        points = {g: points[g] for g in sorted(alive)} or points
    res = _exact(tuples, cols, points, extra_keys)
    rank = F.row_number().over(Window.partitionBy(*(extra_keys or [F.lit(0)])).orderBy(F.round("auc", 9).desc(), "grid_id"))  # of grid points
    return res.withColumn("_rank", rank).where((F.col("_rank") <= k) | F.col("grid_id").isin(*always)).drop("_rank")


def pair_grid_auc(wide_df: DataFrame, cols: Sequence[str], weights: Sequence[float],
                  label: str = "label") -> DataFrame:
    """For every model pair (a, b) and weight w, AUC of w·a + (1−w)·b — one job over the distinct
    pairs of scores."""
    cols = list(cols)
    combos = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    pairs = wide_df.select(label, F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("_va"), F.col(b).alias("_vb"))
                                                      for a, b in combos])).alias("_g")).select(label, "_g.*")
    tuples = score_tuples(pairs, ["_va", "_vb"], label, ["a", "b"])
    e = tuples.select("*", F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias("w"))
    e = e.withColumn("_score", F.col("w") * F.col("_va") + (F.lit(1.0) - F.col("w")) * F.col("_vb"))
    return count_auc(e, "_score", "_tp", "_tn", ["a", "b", "w"]).select("a", "b", "w", "auc")


def gated_auc(wide_df: DataFrame, primary: str, secondary: str, fallback: str, linear: Column,
              thresholds: Sequence[float], alphas: Sequence[float], label: str = "label") -> DataFrame:
    """Where |primary − secondary| > t use α·secondary + (1−α)·fallback, else the linear
    blend; AUC for every (t, α)."""
    base = wide_df.select(label, F.col(primary).alias("_p"), F.col(secondary).alias("_s"),
                          F.col(fallback).alias("_f"), linear.alias("_lin"))
    distinct = score_tuples(base, ["_p", "_s", "_f", "_lin"], label)
    arr = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(float(a)).alias("alpha"))
                    for t in thresholds for a in alphas])
    e = distinct.select("*", F.explode(arr).alias("_g")).select("*", "_g.threshold", "_g.alpha").drop("_g")
    score = F.when(F.abs(F.col("_p") - F.col("_s")) > F.col("threshold"),
                   F.col("alpha") * F.col("_s") + (F.lit(1.0) - F.col("alpha")) * F.col("_f")).otherwise(F.col("_lin"))
    e = e.withColumn("_score", score)
    return count_auc(e, "_score", "_tp", "_tn", ["threshold", "alpha"]).select("threshold", "alpha", "auc")


def softmax_weights(model_auc: DataFrame, temperature: float = 50.0, model: str = "model",
                    metric: str = "auc") -> DataFrame:
    """N19 mix: weights ∝ exp(T·(auc − max auc)), normalised (a tiny table, one row per model)."""
    mx = model_auc.agg(F.max(metric).alias("_mx"))
    j = model_auc.withColumn("_k", F.lit(0)).join(F.broadcast(mx.withColumn("_k", F.lit(0))), "_k")
    j = j.withColumn("_e", F.exp(F.lit(temperature) * (F.col(metric) - F.col("_mx"))))
    tot = j.agg(F.sum("_e").alias("_t")).withColumn("_k", F.lit(0))
    return j.join(F.broadcast(tot), "_k").select(model, metric, (F.col("_e") / F.col("_t")).alias("weight"))


def brier(df: DataFrame, label: str, prob: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols).agg(F.avg((F.col(prob) - F.col(label)) ** 2).alias("brier"))


__all__ = ["wide", "mean_expr", "soft_vote", "percentile_ranks", "logit_blend", "simplex_grid",
           "refine_grid", "grid_auc", "grid_top", "gated_auc", "softmax_weights", "brier", "clip"]
