"""Registered queries: the leak-safe feature builder."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.common import K, applied
from foldwise.catalog.registry import register
from foldwise.operators.foldstats import EVAL
from foldwise.operators.spec import PRESETS, preset

W = S.with_
CATS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
GRPS = (1, 2, 3, 4, 5)
SPECS = (("grp",), ("flag",), ("grp", "flag"))


def _builder_sql(name: str) -> str:
    p = PRESETS[name]
    ctes = [*S.obs_folds(),
            "gq as (select eval_fold, grp, quantile_cont(x1, 0.5) as x1_median, quantile_cont(x2, 0.5) as x2_median from fit group by eval_fold, grp)",
            "gl as (select eval_fold, quantile_cont(x1, 0.5) as x1_median_global, quantile_cont(x2, 0.5) as x2_median_global from fit group by eval_fold)",
            "md as " + S.mode_sql("fit", "cat", ["eval_fold"], "cat_mode"),
            """fi as (select fit.eval_fold, fit.grp, fit.flag, coalesce(fit.x1, gq.x1_median, gl.x1_median_global) as x1,
  coalesce(fit.x2, gq.x2_median, gl.x2_median_global) as x2 from fit left join gq using (eval_fold, grp) join gl using (eval_fold))""",
            """ai as (select app.id, app.eval_fold, app.grp, app.flag, app.c1, app.c2,
  cast(app.x1 is null as integer) as x1_missing, cast(app.x2 is null as integer) as x2_missing, cast(app.cat is null as integer) as cat_missing,
  coalesce(app.x1, gq.x1_median, gl.x1_median_global) as x1, coalesce(app.x2, gq.x2_median, gl.x2_median_global) as x2,
  coalesce(app.cat, md.cat_mode) as cat
  from app left join gq using (eval_fold, grp) left join gl using (eval_fold) left join md using (eval_fold))"""]
    fam = "(c1 + c2 + 1)"
    cols = ["ai.grp", "ai.flag", "ai.x1", "ai.c1", "ai.c2", "ai.x2"]
    cols += [f"coalesce(cast(ai.cat = '{c}' as integer), 0) as cat_{c}" for c in CATS]
    cols += [f"{fam} as family_size", f"cast({fam} = 1 as integer) as is_alone", "ln(1 + ai.x2) as log_x2",
             f"ai.x2 / {fam} as x2_per_person", "ai.grp * 10 + ai.flag as grp_flag"]
    joins = []
    if p["missing_flags"]:
        cols += ["x1_missing", "x2_missing", "cat_missing"]
    if p["age_bins"] == "rule":
        cols.append("case when ai.x1 >= 0 and ai.x1 <= 12 then 0 when ai.x1 > 12 and ai.x1 <= 18 then 1 when ai.x1 > 18 and ai.x1 <= 35 then 2 "
                    "when ai.x1 > 35 and ai.x1 <= 60 then 3 when ai.x1 > 60 and ai.x1 <= 100 then 4 else 2 end as x1_bin")
    if p["fare_bins"] == "quantile":
        ctes.append("qe as (select eval_fold, list_sort(list_distinct(quantile_cont(x2, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) as e from fi group by eval_fold)")
        ctes.append("qi as (select eval_fold, list_slice(e, 2, len(e) - 1) as inner_edges from qe)")
        joins.append("left join qi on ai.eval_fold = qi.eval_fold")
        cols.append("case when ai.x2 is null then -1 else len(list_filter(qi.inner_edges, lambda e: e < ai.x2)) end as x2_qbin")
    if p["interactions"]:
        cols += ["ai.x1 * ai.grp as x1_grp", "ai.x2 * ai.grp as x2_grp", "ln(1 + ai.x2) / ai.grp as log_x2_per_grp",
                 f"{fam} * ai.flag as family_flag", f"cast({fam} = 1 as integer) * ai.flag as alone_flag"]
        for g in GRPS:
            cols += [f"cast(ai.flag = 1 and ai.grp = {g} as integer) as flag1_{g}",
                     f"cast(ai.flag = 0 and ai.grp = {g} as integer) as flag0_{g}"]
    if p["polynomial"]:
        cols += ["ai.x1 * ai.x1 as x1_sq", "ai.x2 * ai.x2 as x2_sq", "ai.x1 * ai.x2 as x1_x2"]
    if p["group_stats"]:
        ctes.append("gm as (select eval_fold, avg(x2) as gm_x2, avg(x1) as gm_x1 from fi group by eval_fold)")
        joins.append("left join gm on ai.eval_fold = gm.eval_fold")
        for c in ("x2", "x1"):
            for sp in SPECS:
                sfx = "_".join(sp)
                t = f"s_{c}_{sfx}"
                keys = ", ".join(sp)
                ctes.append(f"{t} as (select eval_fold, {keys}, quantile_cont({c}, 0.5) as med, avg({c}) as mean, coalesce(stddev_samp({c}), 0) as sd from fi group by eval_fold, {keys})")
                on = " and ".join(f"ai.{k} = {t}.{k}" for k in sp)
                joins.append(f"left join {t} on ai.eval_fold = {t}.eval_fold and {on}")
                sd = f"(case when coalesce({t}.sd, 1) = 0 then 1 else coalesce({t}.sd, 1) end)"
                cols += [f"ai.{c} - coalesce({t}.med, gm.gm_{c}) as {c}_diff_{sfx}",
                         f"(ai.{c} - coalesce({t}.mean, gm.gm_{c})) / {sd} as {c}_z_{sfx}"]
    if p["freq_encoding"]:
        ctes.append("fr as (select eval_fold, grp, count(*) * 1.0 / sum(count(*)) over (partition by eval_fold) as f from fi group by eval_fold, grp)")
        joins.append("left join fr on ai.eval_fold = fr.eval_fold and ai.grp = fr.grp")
        cols.append("coalesce(fr.f, 0.0) as grp_freq")
    if p["rank_features"]:
        ctes.append("rg as (select eval_fold, grp, min(x2) as lo, max(x2) as hi from fi group by eval_fold, grp)")
        joins.append("left join rg on ai.eval_fold = rg.eval_fold and ai.grp = rg.grp")
        lo, hi = "coalesce(rg.lo, 0.0)", "coalesce(rg.hi, 1.0)"
        cols.append(f"case when ai.x2 is null then null else greatest(0.0, least(1.0, (ai.x2 - {lo}) / (case when {hi} <> {lo} then {hi} - {lo} else 1.0 end))) end as x2_pctile_in_grp")
    if p["domain_features"]:
        cols += ["coalesce(cast(ai.x1 <= 12 as integer), 0) as is_child",
                 "coalesce(cast(ai.flag = 1 and ai.c2 > 0 and ai.x1 > 18 as integer), 0) as is_mother",
                 "coalesce(cast(ai.x2 = 0 as integer), 0) as x2_zero",
                 f"cast({fam} between 2 and 4 as integer) as family_small",
                 f"cast({fam} >= 5 as integer) as family_large",
                 f"coalesce(cast(ai.x1 <= 12 and {fam} > 1 as integer), 0) as child_with_family"]
    return W(*ctes) + "select ai.id, ai.eval_fold, " + ",\n  ".join(cols) + "\nfrom ai " + " ".join(joins)


DOUBLES_BUILDER = ["x1", "x2", "log_x2", "x2_per_person", "x1_grp", "x2_grp", "log_x2_per_grp", "x1_sq", "x2_sq",
                   "x1_x2", "grp_freq", "x2_pctile_in_grp",
                   *[f"{c}_{k}_{'_'.join(sp)}" for c in ("x2", "x1") for sp in SPECS for k in ("diff", "z")]]


def _run(spark, sf_dir, name):
    tr, app = applied(spark, sf_dir)
    spec = preset(name, levels=CATS, classes=GRPS)
    model = spec.fit(tr, "fold", K)
    return model.transform(app)


@register("i12_feature_builder_kitchen_sink", ops=["I12", "I13", "P6", "P7", "P8", "P10", "P11", "P22", "I5", "I6", "I7", "I8"],
          doubles=DOUBLES_BUILDER, digits=9, sql=_builder_sql("kitchen_sink"))
def i12_feature_builder_kitchen_sink(spark, sf_dir):
    return _run(spark, sf_dir, "kitchen_sink")


@register("i13_feature_builder_recommended", ops=["I12", "I13"],
          doubles=[d for d in DOUBLES_BUILDER if d not in ("x1_sq", "x2_sq", "x1_x2", "grp_freq", "x2_pctile_in_grp")],
          digits=9, sql=_builder_sql("recommended"))
def i13_feature_builder_recommended(spark, sf_dir):
    return _run(spark, sf_dir, "recommended")


@register("i13_feature_builder_learned_levels", ops=["I13", "P2", "P3", "P22"],
          doubles=[d for d in DOUBLES_BUILDER if d not in ("x1_sq", "x2_sq", "x1_x2", "grp_freq", "x2_pctile_in_grp")],
          digits=9, sql=_builder_sql("recommended"))
def i13_feature_builder_learned_levels(spark, sf_dir):
    """The recommended preset with its default vocabulary: the category's levels are learned from the training rows."""
    tr, app = applied(spark, sf_dir)
    return preset("recommended", classes=GRPS).fit(tr, "fold", K).transform(app)


@register("i13_feature_builder_minimal", ops=["I11", "I13"], doubles=["x1", "x2", "log_x2", "x2_per_person"], digits=9,
          sql=_builder_sql("minimal"))
def i13_feature_builder_minimal(spark, sf_dir):
    return _run(spark, sf_dir, "minimal")


@register("i11_builder_with_extra_function", ops=["I11", "P7", "P22"])
def i11_builder_with_extra_function(spark, sf_dir):
    """v1 builder plus a caller-supplied DataFrame → DataFrame stage (the reference's ``extra_fn``)."""
    tr, app = applied(spark, sf_dir)

    def extra(df):
        return df.withColumn("x2_log_per_family", F.col("log_x2") / F.col("family_size"))

    spec = preset("minimal", levels=CATS, classes=GRPS, extra_fn=extra)
    return spec.fit(tr, "fold", K).transform(app).select("id", EVAL, "x2_log_per_family", "family_size")
