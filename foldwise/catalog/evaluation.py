"""Registered queries: folds, metrics and evaluation (X*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.registry import register
from foldwise.operators.folds import assign_folds
from foldwise.operators.metrics import auc, calibration_curve, classification_metrics
from foldwise.plans.joins import persisted
from foldwise.sources.tables import observations, pseudo_scores


def train_scores(spark, sf_dir):
    """Train-side pseudo-model scores with fold numbers (the OOF score table of the tests)."""
    obs = observations(spark, sf_dir).where(F.col("side") == "train")
    folded = persisted(assign_folds(obs.select("id", "label", "side"), "label", "id", k=5, seed=42))
    rows = folded.drop("fold").join(folded.select("id", "fold"), "id")  # before they are repeated for every model
    return pseudo_scores(rows, keep=["fold"])


SCORES_F = S.with_(S.OBS, "tr as (select * from obs where side = 'train')", S.folds("tr"),
                   S.scores("obsf", "sc0"),
                   "scores as (select sc0.*, obsf.fold from sc0 join obsf using (id))")


@register("x1_stratified_folds", ops=["X1"], sql=S.with_(S.OBS, S.folds("obs")) +
          "select id, label, fold from obsf")
def x1_stratified_folds(spark, sf_dir):
    return assign_folds(observations(spark, sf_dir), "label", "id", k=5, seed=42).select(
        "id", "label", "fold")


@register("x4_auc_by_model_fold", ops=["X4"], doubles=["auc", "n_pos", "n_neg"],
          sql=SCORES_F + "select * from " + S.auc_sql("scores", ["model", "fold"]) + " t")
def x4_auc_by_model_fold(spark, sf_dir):
    return auc(train_scores(spark, sf_dir), "label", "prob", ["model", "fold"])


# ---------------------------------------------------------------- X2-X19
from foldwise.catalog.linkage import HOLDOUT_SQL, holdout_labels  # noqa: E402
from foldwise.functions.features import confidence_filter  # noqa: E402
from foldwise.operators.folds import assign_repeated_folds  # noqa: E402
from foldwise.operators.metrics import fold_summary  # noqa: E402
from foldwise.sources.tables import PSEUDO_MODELS, seeded_scores  # noqa: E402

SF = SCORES_F.removeprefix("with ").rstrip("\n")


@register("x2_x3_x5_fold_metrics", ops=["X2", "X3", "X5", "P20"], doubles=["accuracy", "f1", "logloss", "brier"],
          sql=S.with_(SF) + """select model, fold, count(*) as n,
  avg(case when cast(prob >= 0.5 as integer) = label then 1.0 else 0.0 end) as accuracy,
  coalesce(2.0 * sum(case when prob >= 0.5 and label = 1 then 1 else 0 end) / nullif(2 * sum(case when prob >= 0.5 and label = 1 then 1 else 0 end)
    + sum(case when prob >= 0.5 and label = 0 then 1 else 0 end) + sum(case when prob < 0.5 and label = 1 then 1 else 0 end), 0), 0.0) as f1,
  avg(-(label * ln(greatest(1e-15, least(1 - 1e-15, prob))) + (1 - label) * ln(1 - greatest(1e-15, least(1 - 1e-15, prob))))) as logloss,
  avg((prob - label) * (prob - label)) as brier
from scores group by model, fold""")
def x2_x3_x5_fold_metrics(spark, sf_dir):
    return classification_metrics(train_scores(spark, sf_dir), "label", None, "prob", ["model", "fold"])


@register("x6_calibration_curve", ops=["X6"], doubles=["prob_pred", "prob_true"], sql=S.with_(SF) + """
select model, """ + " + ".join(f"cast(prob > {i / 10!r} as integer)" for i in range(1, 10)) + """ as bin,
  avg(prob) as prob_pred, avg(cast(label as double)) as prob_true, count(*) as n from scores group by all""")
def x6_calibration_curve(spark, sf_dir):
    return calibration_curve(train_scores(spark, sf_dir), "label", "prob", 10, ["model"])


HOLD_SC = HOLDOUT_SQL + [S.scores("obs", "tsc"),
                         "hs as (select tsc.id, tsc.model, tsc.prob, h.survived as label, h.confidence from tsc join holdout h on tsc.id = h.id where h.survived is not null)"]


def _holdout_scores(spark, sf_dir):
    sc = pseudo_scores(observations(spark, sf_dir)).select("id", "model", "prob")
    hl = holdout_labels(spark, sf_dir).where(F.col("survived").isNotNull())
    return sc.join(hl.select("id", F.col("survived").alias("label"), "confidence"), "id")


@register("x9_x10_holdout_auc_by_confidence", ops=["X9", "X10", "P19", "J1"], doubles=["auc", "n_pos", "n_neg"], sql=S.with_(
    *HOLD_SC,
    """lv as (select model, 'all' as level, label, prob from hs
  union all select model, 'sure', label, prob from hs where confidence in ('unique', 'all_agree')
  union all select model, 'unique', label, prob from hs where confidence = 'unique')""",
) + "select * from " + S.auc_sql("lv", ["model", "level"]) + " t")
def x9_x10_holdout_auc_by_confidence(spark, sf_dir):
    hs = _holdout_scores(spark, sf_dir)
    levels = F.filter(F.array(*[F.when(confidence_filter("confidence", lv), F.lit(lv)) for lv in ("all", "sure", "unique")]),
                      lambda x: x.isNotNull())
    return auc(hs.withColumn("level", F.explode(levels)), "label", "prob", ["model", "level"])


FOLD_AUC = "fa as (select * from " + S.auc_sql("scores", ["model", "fold"]) + " t)"


@register("x11_fold_mean_std", ops=["X11", "X7"], doubles=["auc_mean", "auc_std", "auc_std_sample"], sql=S.with_(SF, FOLD_AUC) + """
select model, avg(auc) as auc_mean, stddev_pop(auc) as auc_std, stddev_samp(auc) as auc_std_sample from fa group by model""")
def x11_fold_mean_std(spark, sf_dir):
    fa = auc(train_scores(spark, sf_dir), "label", "prob", ["model", "fold"])
    pop = fold_summary(fa, ["model"], "auc")
    samp = fold_summary(fa, ["model"], "auc", sample=True).select("model", F.col("auc_std").alias("auc_std_sample"))
    return pop.join(samp, "model")


REPEAT_SEEDS = (0, 1, 2, 3, 4)


@register("x12_repeated_cv_robust_score", ops=["X12"], doubles=["auc_mean", "auc_std", "robust"], sql=S.with_(
    S.OBS, "tr as (select * from obs where side = 'train')",
    "rf as (" + "\nunion all\n".join(
        f"select id, label, {s} as seed, cast((row_number() over (partition by label order by {S.u(s, 'id')}, id) - 1) % 5 as integer) as fold from tr"
        for s in REPEAT_SEEDS) + ")",
    S.scores("tr", "sc0"),
    "rs as (select rf.seed, rf.fold, sc0.model, sc0.label, sc0.prob from sc0 join rf on sc0.id = rf.id)",
    "fa as (select * from " + S.auc_sql("rs", ["model", "seed", "fold"]) + " t)",
) + """select model, avg(auc) as auc_mean, stddev_pop(auc) as auc_std, avg(auc) - 0.5 * stddev_pop(auc) as robust, count(*) as n_fits
from fa group by model""")
def x12_repeated_cv_robust_score(spark, sf_dir):
    tr = observations(spark, sf_dir).where(F.col("side") == "train")
    rf = assign_repeated_folds(tr.select("id", "label"), REPEAT_SEEDS, "label", "id", k=5)
    sc = pseudo_scores(tr).select("id", "model", "prob")
    rs = sc.join(rf, "id")
    fa = auc(rs, "label", "prob", ["model", "seed", "fold"])
    return fa.groupBy("model").agg(
        F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"),
        (F.avg("auc") - 0.5 * F.stddev_pop("auc")).alias("robust"), F.count(F.lit(1)).alias("n_fits"))


@register("x13_multi_seed_variance", ops=["X13", "N10"], doubles=["auc_mean", "auc_std", "auc_min", "auc_max", "auc_range"], sql=S.with_(
    S.OBS, S.seeded_scores("obs", "ss"), "st as (select * from ss where side = 'train')",
    "sa as (select * from " + S.auc_sql("st", ["model", "seed"]) + " t)",
) + """select model, avg(auc) as auc_mean, stddev_pop(auc) as auc_std, min(auc) as auc_min, max(auc) as auc_max,
  max(auc) - min(auc) as auc_range from sa group by model""")
def x13_multi_seed_variance(spark, sf_dir):
    ss = seeded_scores(observations(spark, sf_dir)).where(F.col("side") == "train")
    sa = auc(ss, "label", "prob", ["model", "seed"])
    return sa.groupBy("model").agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"),
                                   F.min("auc").alias("auc_min"), F.max("auc").alias("auc_max"),
                                   (F.max("auc") - F.min("auc")).alias("auc_range"))


@register("x15_experiment_comparison", ops=["X15"], doubles=["mean_base", "mean_exp", "mean_diff"], sql=S.with_(SF, FOLD_AUC) + """
select count(*) as n_folds, cast(sum(case when e.auc > b.auc then 1 else 0 end) as bigint) as improved,
  avg(b.auc) as mean_base, avg(e.auc) as mean_exp, avg(e.auc - b.auc) as mean_diff
from fa b join fa e on b.fold = e.fold and b.model = 'm1' and e.model = 'm2'""")
def x15_experiment_comparison(spark, sf_dir):
    fa = auc(train_scores(spark, sf_dir), "label", "prob", ["model", "fold"])
    b = fa.where(F.col("model") == "m1").select("fold", F.col("auc").alias("ab"))
    e = fa.where(F.col("model") == "m2").select("fold", F.col("auc").alias("ae"))
    j = b.join(e, "fold")
    return j.agg(F.count(F.lit(1)).alias("n_folds"), F.sum((F.col("ae") > F.col("ab")).cast("long")).alias("improved"),
                 F.avg("ab").alias("mean_base"), F.avg("ae").alias("mean_exp"),
                 F.avg(F.col("ae") - F.col("ab")).alias("mean_diff"))


@register("x16_oof_distribution_summary", ops=["X16"], doubles=["mean", "std", "min", "max"], sql=S.with_(SF) + """
select model, avg(prob) as mean, stddev_pop(prob) as std, min(prob) as min, max(prob) as max from scores group by model""")
def x16_oof_distribution_summary(spark, sf_dir):
    return train_scores(spark, sf_dir).groupBy("model").agg(
        F.avg("prob").alias("mean"), F.stddev_pop("prob").alias("std"), F.min("prob").alias("min"), F.max("prob").alias("max"))


@register("x17_model_ranking", ops=["X17"], doubles=["auc_mean"], sql=S.with_(SF, FOLD_AUC) + """
select model, auc_mean, cast(rank() over (order by round(auc_mean, 9) desc, model) as integer) as rnk,
  cast(auc_mean > (select avg(auc) from fa where model = 'm1') as integer) as publish
from (select model, avg(auc) as auc_mean from fa group by model) m""")
def x17_model_ranking(spark, sf_dir):
    from pyspark.sql import Window

    fa = auc(train_scores(spark, sf_dir), "label", "prob", ["model", "fold"])
    m = fa.groupBy("model").agg(F.avg("auc").alias("auc_mean"))
    base = m.where(F.col("model") == "m1").select(F.col("auc_mean").alias("_b")).withColumn("_k", F.lit(0))
    j = m.withColumn("_k", F.lit(0)).join(F.broadcast(base), "_k")
    w = Window.orderBy(F.round("auc_mean", 9).desc(), "model")  # one row per model
    return j.select("model", "auc_mean", F.rank().over(w).alias("rnk"), (F.col("auc_mean") > F.col("_b")).cast("int").alias("publish"))


@register("x18_cv_holdout_gap", ops=["X18", "X9"], doubles=["cv_auc", "holdout_auc", "gap"], sql=S.with_(
    *HOLD_SC,
    "tr as (select * from obs where side = 'train')", S.folds("tr", name="trf"), S.scores("trf", "sc0"),
    "scores as (select sc0.*, trf.fold from sc0 join trf using (id))",
    "cv as (select model, auc as cv_auc from " + S.auc_sql("scores", ["model"]) + " t)",
    "ho as (select model, auc as holdout_auc from " + S.auc_sql("hs", ["model"]) + " t)",
) + """select cv.model, cv_auc, holdout_auc, cv_auc - holdout_auc as gap, cast(abs(cv_auc - holdout_auc) < 0.005 as integer) as in_band
from cv join ho on cv.model = ho.model""")
def x18_cv_holdout_gap(spark, sf_dir):
    cv = auc(train_scores(spark, sf_dir), "label", "prob", ["model"]).select("model", F.col("auc").alias("cv_auc"))
    ho = auc(_holdout_scores(spark, sf_dir), "label", "prob", ["model"]).select("model", F.col("auc").alias("holdout_auc"))
    j = cv.join(ho, "model")
    return j.select("model", "cv_auc", "holdout_auc", (F.col("cv_auc") - F.col("holdout_auc")).alias("gap"),
                    (F.abs(F.col("cv_auc") - F.col("holdout_auc")) < 0.005).cast("int").alias("in_band"))


# fixed values: score tiers (lower bounds) and model categories of the tier report
TIERS = (("S", 0.85), ("A", 0.75), ("B", 0.65))
CATEGORY = {"m1": "weak", "m2": "weak", "m3": "strong", "m4": "strong", "m5": "strong"}


@register("x19_score_tiers_and_category_best", ops=["X19"], doubles=["holdout_auc"], sql=S.with_(
    *HOLD_SC, "ho as (select model, auc as holdout_auc from " + S.auc_sql("hs", ["model"]) + " t)",
    "ct as (select * from (values " + ", ".join(f"('{m}', '{c}')" for m, c in CATEGORY.items()) + ") v(model, category))",
) + "select ho.model, ct.category, holdout_auc, case " + " ".join(f"when holdout_auc >= {t!r} then '{n}'" for n, t in TIERS) +
    """ else 'C' end as tier, cast(ho.model = arg_max(ho.model, (round(holdout_auc, 9), ho.model)) over (partition by ct.category) as integer) as category_best
from ho join ct on ho.model = ct.model""")
def x19_score_tiers_and_category_best(spark, sf_dir):
    ho = auc(_holdout_scores(spark, sf_dir), "label", "prob", ["model"]).select("model", F.col("auc").alias("holdout_auc"))
    pairs = []
    for m, c in CATEGORY.items():
        pairs += [F.lit(m), F.lit(c)]
    ho = ho.withColumn("category", F.create_map(*pairs)[F.col("model")])
    tier = None
    for n, t in TIERS:
        tier = F.when(F.col("holdout_auc") >= t, F.lit(n)) if tier is None else tier.when(F.col("holdout_auc") >= t, F.lit(n))
    best = ho.groupBy("category").agg(F.max_by("model", F.struct(F.round("holdout_auc", 9), F.col("model"))).alias("_best"))
    j = ho.join(F.broadcast(best), "category")  # one row per category
    return j.select("model", "category", "holdout_auc", tier.otherwise(F.lit("C")).alias("tier"),
                    (F.col("model") == F.col("_best")).cast("int").alias("category_best"))


# ---------------------------------------------------------------- flagship (the entry query)
from foldwise.catalog.common import K, applied  # noqa: E402
from foldwise.catalog.imputation import I2_SQL  # noqa: E402
from foldwise.functions.features import base_derived  # noqa: E402
from foldwise.operators.foldstats import EVAL  # noqa: E402
from foldwise.operators.impute import apply_imputer, fit_imputer  # noqa: E402
from foldwise.sources.tables import pseudo_score_expr  # noqa: E402


@register("flagship_fold_impute_auc", ops=["X1", "I2", "I3", "P4", "P5", "X4"], doubles=["auc", "n_pos", "n_neg"],
          sql=I2_SQL.rstrip("\n") + """,
fr as (select app.fold, app.label, coalesce(app.x1, gq.x1_median, gl.x1_median_global) as x1, ln(1 + app.x2) as log_x2,
  app.x2 / (app.c1 + app.c2 + 1) as x2_per_person, """ + S.pseudo_prob(3).replace("label", "app.label").replace("(id", "(app.id").replace(", id", ", app.id") + """ as prob_m3
  from app left join gq using (eval_fold, grp) left join gl using (eval_fold) where app.side = 'train'),
lg as (select 'x1' as score, fold, label, x1 as v from fr union all select 'log_x2', fold, label, log_x2 from fr
  union all select 'x2_per_person', fold, label, x2_per_person from fr union all select 'prob_m3', fold, label, prob_m3 from fr)
select * from """ + S.auc_sql("lg", ["score", "fold"], score="v") + " t")
def flagship_fold_impute_auc(spark, sf_dir):
    """obs → stratified folds → leak-safe group-median imputation fitted per eval fold → derived
    features → tie-aware AUC of each score per (score, fold), OOF on the training side."""
    tr, app = applied(spark, sf_dir)
    g, glob = fit_imputer(tr, "grp", ["x1", "x2"], ["cat"], "fold", K)
    rows = apply_imputer(app.where(F.col("side") == "train"), g, glob, "grp", ["x1", "x2"], ["cat"])
    rows = rows.select("fold", "label", "x1", *base_derived("c1", "c2", "x2", "grp", "flag"),
                       pseudo_score_expr(3).alias("prob_m3"))
    stacked = rows.select("fold", "label", F.explode(F.array(*[
        F.struct(F.lit(n).alias("score"), F.col(n).cast("double").alias("v"))
        for n in ("x1", "log_x2", "x2_per_person", "prob_m3")])).alias("s")).select("fold", "label", "s.*")
    return auc(stacked, "label", "v", ["score", "fold"])
