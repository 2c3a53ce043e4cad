"""Cross-validation with out-of-fold scores.

Features come from one ``FeatureModel`` fitted for every eval fold (leak-safe: statistics of eval
fold f never see fold-f rows). The training matrices of all folds are one frame (each training row
repeated for the k-1 folds it trains — inherent to k-fold CV), materialised once; the driver loops
only around ``fit`` (small fits side by side, ``fits``). Predictions are unioned into the long score table (id, model, fold, prob).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.fits import Group, fit_groups, score_all, union_all
from foldwise.operators.foldstats import EVAL, eval_targets
from foldwise.operators.metrics import auc, classification_metrics
from foldwise.operators.models import assembler, positive_probability
from foldwise.plans.joins import persisted
from foldwise.plans.session import cut_lineage

Factory = Callable[[int, int], object]  # (n_features, n_rows) -> estimator


def fold_sizes(fit_rows: DataFrame, fold_col: str = EVAL) -> dict[int, int]:
    """Rows of each fold (one count per fold): what ``regParam = 1 / (C · n)`` needs."""
    return {r[0]: r["count"] for r in fit_rows.groupBy(fold_col).count().collect()}


def training_frames(train: DataFrame, fold_col: str, k: int) -> DataFrame:
    """Each training row tagged with every eval fold it trains (fold != f)."""
    return train.withColumn(EVAL, F.explode(F.filter(eval_targets(F.col(fold_col), k), lambda f: f >= 0)))


def cv_matrices(train: DataFrame, feature_model, k: int, fold_col: str = "fold", label: str = "label",
                id_col: str = "id", checkpoint: bool = True, extra: Sequence[str] = ()):
    """(training rows of every eval fold, validation rows) with all feature columns, built once.
    With ``checkpoint`` they are written to the shared checkpoint folder (lineage cut, survives
    executor loss); otherwise persisted."""
    keep = (id_col, EVAL, label, *extra)
    fit_rows = feature_model.transform(training_frames(train, fold_col, k), keep=keep)
    val_rows = feature_model.transform(train.withColumn(EVAL, F.col(fold_col)), keep=keep)
    if checkpoint:
        return cut_lineage(fit_rows), cut_lineage(val_rows)
    return persisted(fit_rows), persisted(val_rows)


def oof_scores(fit_rows: DataFrame, val_rows: DataFrame, cols: Sequence[str], models: Mapping[str, Factory],
               k: int, sizes: Mapping[int, int] | None = None, label: str = "label", id_col: str = "id",
               subsets: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Fit every learner on each fold's training rows (features ``cols``, or the learner's own of ``subsets``),
    score the fold. A fold's rows are read once for all learners. ``sizes``: training rows of each eval fold,
    counted unless given."""
    return oof_scores_of([(fit_rows, val_rows, cols)], models, k, sizes, label, id_col, subsets)[0]


def oof_scores_of(matrices: Sequence[tuple[DataFrame, DataFrame, Sequence[str]]], models: Mapping[str, Factory], k: int,
                  sizes: Mapping[int, int] | None = None, label: str = "label", id_col: str = "id",
                  subsets: Mapping[str, Sequence[str]] | None = None) -> list[DataFrame]:
    """``oof_scores`` of several (training rows, validation rows, features) over the same folds: the small fits of all
    of them run side by side."""
    sizes = fold_sizes(matrices[0][0]) if sizes is None else sizes
    owns = [{name: list((subsets or {}).get(name, cols)) for name in models} for *_, cols in matrices]
    fitted = fit_groups([Group(fit_rows.where(F.col(EVAL) == f), sizes.get(f, 0),
                               [(own[name], make(len(own[name]), sizes.get(f, 0))) for name, make in models.items()])
                         for (fit_rows, _, _), own in zip(matrices, owns) for f in range(k)], keep=[label])
    out = []
    for i, ((_, val_rows, _), own) in enumerate(zip(matrices, owns)):
        parts = []
        for f in range(k):
            pred = score_all(val_rows.where(F.col(EVAL) == f), [(name, own[name], m) for name, m in zip(models, fitted[i * k + f])], [id_col, label])
            parts.append(pred.select(id_col, "model", F.lit(f).alias("fold"), "prob", label))
        out.append(union_all(parts))
    return out


def cross_validate_oof(train: DataFrame, models: Mapping[str, Factory], feature_model, k: int,
                       fold_col: str = "fold", label: str = "label", id_col: str = "id",
                       checkpoint: bool = True) -> tuple[DataFrame, DataFrame]:
    """Returns (scores(id, model, fold, prob, label), per-fold metrics)."""
    cols = feature_model.columns
    fit_rows, val_rows = cv_matrices(train, feature_model, k, fold_col, label, id_col, checkpoint)
    scores = persisted(oof_scores(fit_rows, val_rows, cols, models, k, None, label, id_col))
    metrics = classification_metrics(scores, label, None, "prob", ["model", "fold"]).join(
        auc(scores, label, "prob", ["model", "fold"]).select("model", "fold", "auc"), ["model", "fold"])
    return scores, metrics


def cross_validate(train: DataFrame, models: Mapping[str, Factory], feature_model, k: int, **kw) -> DataFrame:
    """Per-fold metrics plus their mean per model (fold = -1)."""
    _, m = cross_validate_oof(train, models, feature_model, k, **kw)
    mean = m.groupBy("model").agg(*[F.avg(c).alias(c) for c in ("n", "accuracy", "f1", "logloss", "brier", "auc")])
    return m.unionByName(mean.withColumn("fold", F.lit(-1)).withColumn("n", F.col("n").cast("long")), allowMissingColumns=True)


def fit_full_and_score(train: DataFrame, test: DataFrame, make: Factory, feature_model,
                       label: str = "label", id_col: str = "id"):
    """Fit on every training row (eval fold -1 statistics), score the test rows."""
    cols = feature_model.columns
    asm = assembler(cols)
    rows = feature_model.transform(train.withColumn(EVAL, F.lit(-1)), keep=(id_col, EVAL, label))
    te = asm.transform(feature_model.transform(test.withColumn(EVAL, F.lit(-1)), keep=(id_col, EVAL)))
    n = train.count()
    ((model,),) = fit_groups([Group(rows, n, [(cols, make(len(cols), n))])], keep=[label])
    return model, positive_probability(model.transform(te)).select(id_col, "prob"), asm.transform(rows)


def nested_meta_cv(oof_wide: DataFrame, score_cols: Sequence[str], Cs: Sequence[float], outer_col: str,
                   inner_col: str, k: int, label: str = "label", max_iter: int = 100) -> DataFrame:
    """For each outer fold choose the meta-learner's C by inner-fold AUC (inner folds only see
    outer-training rows), then score that choice on the outer fold."""
    from foldwise.operators.models import logistic

    cols = list(score_cols)
    data = persisted(oof_wide.select(outer_col, inner_col, label, *cols))
    cells = data.groupBy(outer_col, inner_col).count().collect()  # at most k * k

    def n(f, g=None):
        return sum(r["count"] for r in cells if r[0] != f and (g is None or r[1] != g))

    best, preds = {}, []
    for f in range(k):  # an outer fold's inner fits side by side, then its own
        outer_tr = data.where(F.col(outer_col) != f)
        fitted = fit_groups([Group(outer_tr.where(F.col(inner_col) != g), n(f, g),
                                   [(cols, logistic(c, n(f, g), max_iter=max_iter, label=label)) for c in Cs]) for g in range(k)], keep=[label])
        scored = union_all([score_all(outer_tr.where(F.col(inner_col) == g), [(str(i), cols, m) for i, m in enumerate(ms)], [label])
                            for g, ms in enumerate(fitted)])
        inner = {int(r["model"]): r["auc"] for r in auc(scored, label, "prob", ["model"]).collect()}
        best[f] = (None, -1.0)
        for i, c in enumerate(Cs):  # the first C of the largest AUC
            a = inner.get(i)
            if a is not None and a > best[f][1]:
                best[f] = (c, a)
        ((m,),) = fit_groups([Group(outer_tr, n(f), [(cols, logistic(best[f][0], n(f), max_iter=max_iter, label=label))])], keep=[label])
        preds.append(score_all(data.where(F.col(outer_col) == f), [(str(f), cols, m)], [label]))
    outer = {int(r["model"]): r["auc"] for r in auc(union_all(preds), label, "prob", ["model"]).collect()}
    rows = [(f, float(best[f][0]), float(best[f][1]), float(outer[f]) if outer.get(f) is not None else None) for f in range(k)]
    return oof_wide.sparkSession.createDataFrame(rows, "outer_fold int, best_C double, inner_auc double, outer_auc double")
