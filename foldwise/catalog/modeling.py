"""Registered queries: Spark ML learners, cross-validation, stacking, calibration, model averaging,
domain classifier and weighted training (M1-M10, X7, X8, X14, N7-N9, N11, N19, D7, D10).

Model fits are not SQL: these are rows-only checks (the invariant tests live in tests/)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from foldwise.catalog.common import K, SEED
from foldwise.catalog.registry import register
from foldwise.operators import cv as CV
from foldwise.operators import drift as D
from foldwise.operators import models as M
from foldwise.operators.blend import softmax_weights, wide
from foldwise.operators.fits import Group, fit_groups, score_all, union_all
from foldwise.operators.foldstats import EVAL, train_eval_frame
from foldwise.operators.folds import assign_folds, assign_repeated_folds
from foldwise.operators.blend import logit_blend, mean_expr
from foldwise.operators.isotonic import apply_isotonic, fit_isotonic
from foldwise.operators.metrics import auc, classification_metrics
from foldwise.operators.spec import preset
from foldwise.plans.joins import persisted
from foldwise.sources.tables import PSEUDO_MODELS, observations, pseudo_score_expr, with_signal_label

CATS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
GRPS = (1, 2, 3, 4, 5)
# run-time sizes of the registered model queries (the factories default to the reference's sizes)
TREES, BOOST_ITERS, MLP_ITERS, LR_ITERS = 100, 30, 500, 30


# run-time sizes of the meta-learner searches (the reference's: 3 seeds, 5 C, nested 4 C)
META_SEEDS, META_C, NESTED_C = (123, 456), (0.1, 1.0), (0.1, 1.0)


def _split(spark, sf_dir):
    obs = with_signal_label(observations(spark, sf_dir))
    tr = persisted(assign_folds(obs.where(F.col("side") == "train"), "label", "id", k=K, seed=SEED))
    te = obs.where(F.col("side") == "test")
    return tr, te


def _features(tr, name="minimal"):
    return preset(name, levels=CATS, classes=GRPS).fit(tr, "fold", K)


def _lr(C=1.0):
    return lambda d, n: M.logistic(C, n, max_iter=LR_ITERS)


@register("m1_m8_logreg_coefficients", ops=["M1", "M8"])
def m1_m8_logreg_coefficients(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    fm = _features(tr)
    model, _, _ = CV.fit_full_and_score(tr, te, _lr(1.0), fm)
    return M.coefficients(spark, model, fm.columns).orderBy(F.col("magnitude").desc())


@register("m2_m7_forest_importance", ops=["M2", "M7"])
def m2_m7_forest_importance(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    fm = _features(tr)
    make = lambda d, n: M.factory("random_forest", d, n, n_estimators=TREES)
    model, _, _ = CV.fit_full_and_score(tr, te, make, fm)
    return M.feature_importance(spark, model, fm.columns).orderBy(F.col("importance").desc())


@register("m3_m9_boosting_loss_curve", ops=["M3", "M9"])
def m3_m9_boosting_loss_curve(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    fm = _features(tr)
    make = lambda d, n: M.factory("gbt_depthwise", d, n, n_estimators=BOOST_ITERS)
    model, _, fitted = CV.fit_full_and_score(tr, te, make, fm)
    return M.loss_curve(spark, model, fitted)


@register("m4_m5_m6_learners_cv", ops=["M4", "M5", "M6", "X7", "X8"])
def m4_m5_m6_learners_cv(spark, sf_dir):
    tr, _ = _split(spark, sf_dir)
    fm = _features(tr)
    learners = {
        "gbt_leafwise": lambda d, n: M.factory("gbt_leafwise", d, n, n_estimators=BOOST_ITERS),
        "gbt_ordered": lambda d, n: M.factory("gbt_ordered", d, n, n_estimators=BOOST_ITERS),
        "mlp": lambda d, n: M.factory("mlp", d, n, max_iter=MLP_ITERS),
    }
    return CV.cross_validate(tr, learners, fm, K)


@register("m6_m9_network_loss_curve", ops=["M6", "M9"])
def m6_m9_network_loss_curve(spark, sf_dir):
    """The network at its default size: training and held-out loss of every iteration until it stops."""
    tr, te = _split(spark, sf_dir)
    model, _, _ = CV.fit_full_and_score(tr, te, lambda d, n: M.factory("mlp", d, n), _features(tr))
    return M.loss_curve(spark, model)


@register("x8_oof_scores_logreg_forest", ops=["X8", "X7", "M1", "M2"])
def x8_oof_scores_logreg_forest(spark, sf_dir):
    tr, _ = _split(spark, sf_dir)
    fm = _features(tr, "recommended")
    learners = {"logreg": _lr(1.0), "random_forest": lambda d, n: M.factory("random_forest", d, n, n_estimators=TREES)}
    scores, _ = CV.cross_validate_oof(tr, learners, fm, K)
    return scores


@register("m10_full_fit_test_scores", ops=["M10", "S7"])
def m10_full_fit_test_scores(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    fm = _features(tr, "recommended")
    _, scored, _ = CV.fit_full_and_score(tr, te, _lr(1.0), fm)
    return scored


def _oof_wide(spark, sf_dir):
    """Pseudo-model OOF scores (train side) as a wide table with the outer fold."""
    obs = observations(spark, sf_dir)
    tr = assign_folds(obs.where(F.col("side") == "train"), "label", "id", k=K, seed=SEED)
    cols = [pseudo_score_expr(i + 1).alias(m) for i, m in enumerate(PSEUDO_MODELS)]
    return tr.select("id", "label", "fold", *cols)


@register("x14_nested_cv_meta_learner", ops=["X14", "N7"])
def x14_nested_cv_meta_learner(spark, sf_dir):
    w = _oof_wide(spark, sf_dir)
    inner = assign_repeated_folds(w.select("id", "label", "fold"), [7], "label", "id", k=K, out="inner").select("id", "inner")
    w = persisted(w.join(inner, "id"))
    return CV.nested_meta_cv(w, list(PSEUDO_MODELS), list(NESTED_C), "fold", "inner", K, max_iter=LR_ITERS)


def _meta_cv(data, subsets, Cs):
    """(id, label, seed, model, prob): out-of-fold scores of a meta-learner per seed, subset and C (model: both)."""
    cells = {(r["seed"], r["meta_fold"]): r["count"] for r in data.groupBy("seed", "meta_fold").count().collect()}
    of = {f"{name}|{C}": (cols, C) for name, cols in subsets.items() for C in Cs}
    pairs = [(s, f) for s in META_SEEDS for f in range(K)]
    groups = []
    for s, f in pairs:
        n = sum(c for (seed, fold), c in cells.items() if seed == s and fold != f)
        groups.append(Group(data.where((F.col("seed") == s) & (F.col("meta_fold") != f)), n,
                            [(cols, M.logistic(C, n, max_iter=LR_ITERS)) for cols, C in of.values()]))
    preds = [score_all(data.where((F.col("seed") == s) & (F.col("meta_fold") == f)),
                       [(name, cols, m) for (name, (cols, _)), m in zip(of.items(), models)], ["id", "label", "seed"])
             for (s, f), models in zip(pairs, fit_groups(groups))]
    return union_all(preds)


def _meta_aucs(oof):
    """(model, seed) → AUC."""
    return {(r["model"], r["seed"]): r["auc"] for r in auc(oof, "label", "prob", ["model", "seed"]).collect()}


@register("n7_n8_stacking_grid", ops=["N7", "N8"])
def n7_n8_stacking_grid(spark, sf_dir):
    """Meta logistic regression on OOF scores: C sweep × meta seeds (own fold split per seed) ×
    passthrough of original features; AUC averaged over seeds."""
    w = _oof_wide(spark, sf_dir).join(observations(spark, sf_dir).select("id", "x2", "flag", "grp"), "id")
    subsets = {p: list(PSEUDO_MODELS) + (["x2", "flag", "grp"] if p else []) for p in (False, True)}
    found = _meta_aucs(_meta_cv(_meta_folds(w), subsets, META_C))
    rows = []
    for passthrough in subsets:
        for C in META_C:
            aucs = [found[f"{passthrough}|{C}", s] for s in META_SEEDS]
            mean = sum(aucs) / len(aucs)
            rows.append((passthrough, C, float(mean), float((sum((a - mean) ** 2 for a in aucs) / len(aucs)) ** 0.5)))
    return spark.createDataFrame(rows, "passthrough boolean, C double, auc double, auc_std double")


def _meta_folds(w):
    """The rows once per meta seed, each seed with folds of its own."""
    w = persisted(w)  # numbering the folds reads it three times
    folds = assign_repeated_folds(w.select("id", "label"), META_SEEDS, "label", "id", k=K, out="meta_fold").select("id", "seed", "meta_fold")
    return persisted(w.join(folds, "id"))


@register("n7_stacked_oof_scores", ops=["N7"])
def n7_stacked_oof_scores(spark, sf_dir):
    """The stacked score of every training row: the meta-learner with the C of the best mean AUC over the seeds,
    its out-of-fold scores averaged over the seeds."""
    oof = persisted(_meta_cv(_meta_folds(_oof_wide(spark, sf_dir)), {"": list(PSEUDO_MODELS)}, META_C))
    found = _meta_aucs(oof)
    best = max(META_C, key=lambda C: sum(found[f"|{C}", s] for s in META_SEEDS))  # the first of equal ones
    return oof.where(F.col("model") == f"|{best}").groupBy("id", "label").agg(
        F.avg("prob").alias("prob"), F.count("*").alias("n_seeds")).withColumn("C", F.lit(best))


@register("n9_final_stacking_weights", ops=["N9"])
def n9_final_stacking_weights(spark, sf_dir):
    """Meta learner on the full OOF table, applied to the test-side scores; its weights."""
    obs = observations(spark, sf_dir)
    cols = [pseudo_score_expr(i + 1).alias(m) for i, m in enumerate(PSEUDO_MODELS)]
    tr = obs.where(F.col("side") == "train").select("id", "label", *cols)
    te = obs.where(F.col("side") == "test").select("id", "label", *cols)
    asm = M.assembler(list(PSEUDO_MODELS))
    model = M.logistic(1.0, tr.count(), max_iter=LR_ITERS).fit(asm.transform(tr))
    coef = M.coefficients(spark, model, list(PSEUDO_MODELS)).select("feature", "coefficient")
    scored = M.positive_probability(model.transform(asm.transform(te)))
    test_auc = auc(scored, "label", "prob").select(F.lit("test_auc").alias("feature"), F.col("auc").alias("coefficient"))
    return coef.unionByName(test_auc)


def _calibrated(w):
    """(id, label, model, method, prob) of every model's raw and calibrated scores. The isotonic calibrators of
    all models and thirds are one fit, keyed by both; a row takes the steps of the other two thirds."""
    thirds = assign_folds(w.select("id", "label"), "label", "id", k=3, seed=11, out="third").select("id", "third")
    scores = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("s")) for m in PSEUDO_MODELS])).alias("m")
    d = persisted(w.join(thirds, "id").select("id", "label", "third", scores).select("id", "label", "third", "m.*"))
    key = F.concat_ws("|", "model", F.col("third").cast("string"))
    steps = fit_isotonic(d.withColumn("key", key), "s", "label", "key")
    other = d.withColumn("third", F.explode(F.filter(F.array(*[F.lit(t) for t in range(3)]), lambda t: t != F.col("third"))))
    parts = [apply_isotonic(other.withColumn("key", key), steps, "s", by="key").select("id", "model", F.lit("isotonic").alias("method"), "prob")]
    scored = persisted(w.join(thirds, "id").select("id", "label", "third", *PSEUDO_MODELS))
    sizes = CV.fold_sizes(scored, "third")
    platt = fit_groups([Group(scored.where(F.col("third") == t), sizes.get(t, 0),
                              [([m], LogisticRegression(featuresCol=M.FEATURES, labelCol="label", regParam=0.0)) for m in PSEUDO_MODELS]) for t in range(3)])
    for t in range(3):  # the two thirds that the calibrators didn't see
        rest = score_all(scored.where(F.col("third") != t), [(m, [m], x) for m, x in zip(PSEUDO_MODELS, platt[t])], ["id"])
        parts.append(rest.select("id", "model", F.lit("sigmoid").alias("method"), "prob"))
    mean = union_all(parts).groupBy("id", "model", "method").agg(F.avg("prob").alias("prob")).join(d.select("id", "model", "label"), ["id", "model"])
    return persisted(mean.unionByName(d.select("id", "model", "label", F.lit("none").alias("method"), F.col("s").alias("prob"))))


@register("x21_calibrated_blends", ops=["X21", "N11", "N12"])
def x21_calibrated_blends(spark, sf_dir):
    """The plain mean and the logit blend of the models' scores, raw and calibrated: AUC and Brier score."""
    cal = _calibrated(_oof_wide(spark, sf_dir))
    wide = cal.groupBy("id", "label", "method").pivot("model", list(PSEUDO_MODELS)).agg(F.first("prob"))
    blends = F.explode(F.array(F.struct(F.lit("average").alias("blend"), mean_expr(list(PSEUDO_MODELS)).alias("prob")),
                               F.struct(F.lit("logit").alias("blend"), logit_blend(list(PSEUDO_MODELS)).alias("prob")))).alias("b")
    rows = wide.select("label", "method", blends).select("label", "method", "b.*")
    brier = rows.groupBy("method", "blend").agg(F.avg((F.col("prob") - F.col("label")) ** 2).alias("brier"))
    return auc(rows, "label", "prob", ["method", "blend"]).select("method", "blend", "auc").join(brier, ["method", "blend"])


@register("n11_probability_calibration", ops=["N11", "X5", "X4"])
def n11_probability_calibration(spark, sf_dir):
    """Per model: sigmoid (Platt) and isotonic calibration, cv = 3 — each calibrator is fitted on one
    third of the rows' scores, and a row's output is the average of the calibrators of the other two
    thirds, so no row is scored by a calibrator that saw it; Brier and AUC per method, best method per
    model by AUC (on ties none, then the alphabet)."""
    cal = _calibrated(_oof_wide(spark, sf_dir))
    res = classification_metrics(cal, "label", None, "prob", ["model", "method"]).join(auc(cal, "label", "prob", ["model", "method"]), ["model", "method"])
    res = res.select("model", "method", "brier", "auc")
    from pyspark.sql import Window
    w_ = Window.partitionBy("model").orderBy(F.desc("auc"), F.col("method") != "none", "method")  # 3 rows per model
    return res.withColumn("best", (F.row_number().over(w_) == 1).cast("int"))


@register("n19_model_averaging", ops=["N19", "P21", "N20"])
def n19_model_averaging(spark, sf_dir):
    """Logistic models over named feature subsets × C values (one set of CV matrices, assembled per
    subset); weights softmax(50·(auc − max)) from their OOF AUC; the weighted average of their OOF
    probabilities scored by AUC."""
    tr, _ = _split(spark, sf_dir)
    fm = _features(tr)
    subsets = {"all": None, "base": ["grp", "flag", "x1", "x2"], "family": ["c1", "c2", "family_size", "is_alone"]}
    fit_rows, val_rows = CV.cv_matrices(tr, fm, K)
    models = {f"{sname}_C{C}": _lr(C) for sname in subsets for C in (0.1, 1.0)}
    own = {f"{sname}_C{C}": [c for c in fm.columns if wanted is None or c in wanted] for sname, wanted in subsets.items() for C in (0.1, 1.0)}
    scores = persisted(CV.oof_scores(fit_rows, val_rows, fm.columns, models, K, subsets=own))
    ma = auc(scores, "label", "prob", ["model"])
    wts = softmax_weights(ma, 50.0)
    mix = scores.join(F.broadcast(wts.select("model", "weight")), "model").groupBy("id", "label").agg(
        (F.sum(F.col("weight") * F.col("prob")) / F.sum("weight")).alias("prob"))
    mix_auc = auc(mix, "label", "prob").select(F.lit("averaged").alias("model"), "auc", F.lit(None).cast("double").alias("weight"))
    return wts.select("model", "auc", "weight").unionByName(mix_auc)


@register("d7_domain_classifier", ops=["D7", "D8", "M3"])
def d7_domain_classifier(spark, sf_dir):
    """Train-vs-test classifier with CV probabilities; accuracy ≥ .55 means a shift."""
    obs = observations(spark, sf_dir).withColumn("is_test", (F.col("side") == "test").cast("int"))
    folded = persisted(assign_folds(obs.drop("label").withColumnRenamed("is_test", "label"), "label", "id", k=K, seed=SEED))
    fm = preset("minimal", levels=CATS, classes=GRPS).fit(folded, "fold", K)
    make = lambda d, n: M.factory("gbt_depthwise", d, n, n_estimators=BOOST_ITERS)
    scores, _ = CV.cross_validate_oof(folded, {"domain": make}, fm, K)
    acc = scores.agg(F.avg(((F.col("prob") >= 0.5).cast("int") == F.col("label")).cast("double")).alias("accuracy"),
                     F.avg(D.importance_weight("prob")).alias("mean_weight"))
    return acc.withColumn("shift", (F.col("accuracy") >= 0.55).cast("int"))


@register("d10_weighted_training_vote", ops=["D10", "D8", "N1"])
def d10_weighted_training_vote(spark, sf_dir):
    """Importance-weighted fits (weight column on every learner) and their soft vote on the test rows."""
    tr, te = _split(spark, sf_dir)
    tr = tr.withColumn("w", D.importance_weight(pseudo_score_expr(2)))
    fm = _features(tr)
    fit = fm.transform(tr.withColumn(EVAL, F.lit(-1)), keep=("id", EVAL, "label", "w"))
    test = fm.transform(te.withColumn(EVAL, F.lit(-1)), keep=("id", EVAL, "label"))
    n = tr.count()
    learners = {"logreg": M.logistic(1.0, n, max_iter=LR_ITERS, weight="w"), "random_forest": M.random_forest(TREES, weight="w"),
                "gbt": M.gbt(BOOST_ITERS, weight="w")}
    (models,) = fit_groups([Group(fit, n, [(fm.columns, est) for est in learners.values()])], keep=["label", "w"])
    allp = persisted(score_all(test, [(name, fm.columns, m) for name, m in zip(learners, models)], ["id", "label"]))
    vote = allp.groupBy("id", "label").agg(F.avg("prob").alias("prob")).withColumn("model", F.lit("weighted_vote"))
    return auc(allp.unionByName(vote.select("id", "label", "model", "prob")), "label", "prob", ["model"])


__all__ = ["train_eval_frame", "wide"]
