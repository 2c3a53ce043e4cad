"""Registered queries: imputation and train statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.common import K, applied, split
from foldwise.catalog.registry import register
from foldwise.operators import impute as I
from foldwise.operators.foldstats import EVAL
from foldwise.sources.tables import observations

W = S.with_


@register("i1_own_table_fill", ops=["I1"], doubles=["x1", "x2"], sql=W(
    S.OBS,
    "med as (select side, quantile_cont(x1, 0.5) as m1, quantile_cont(x2, 0.5) as m2 from obs group by side)",
    "md as " + S.mode_sql("obs", "cat", ["side"], "mc"),
) + """select id, side, coalesce(x1, m1) as x1, coalesce(x2, m2) as x2, coalesce(cat, mc) as cat
from obs join med using (side) join md using (side)""")
def i1_own_table_fill(spark, sf_dir):
    obs = observations(spark, sf_dir).select("id", "side", "x1", "x2", "cat")
    parts = [I.fill_from_own_table(obs.where(F.col("side") == s), ["x1", "x2"], ["cat"])
             for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


I2_SQL = W(
    *S.obs_folds(),
    "gq as (select eval_fold, grp, quantile_cont(x1, 0.5) as x1_median, quantile_cont(x2, 0.5) as x2_median from fit group by eval_fold, grp)",
    "gl as (select eval_fold, quantile_cont(x1, 0.5) as x1_median_global, quantile_cont(x2, 0.5) as x2_median_global from fit group by eval_fold)",
    "md as " + S.mode_sql("fit", "cat", ["eval_fold"], "cat_mode"),
)


@register("i2_train_stats_by_fold", ops=["I2"], doubles=["x1_median", "x2_median", "x1_median_global",
                                                          "x2_median_global"],
          sql=I2_SQL + "select * from gq join gl using (eval_fold) join md using (eval_fold)")
def i2_train_stats_by_fold(spark, sf_dir):
    _, tr, _ = split(spark, sf_dir)
    g, glob = I.fit_imputer(tr, "grp", ["x1", "x2"], ["cat"], "fold", K)
    return g.join(glob, EVAL)


@register("i3_group_median_impute", ops=["I3", "P1"], doubles=["x1", "x2"], sql=I2_SQL + """
select id, eval_fold, coalesce(app.x1, gq.x1_median, gl.x1_median_global) as x1,
  coalesce(app.x2, gq.x2_median, gl.x2_median_global) as x2, coalesce(app.cat, md.cat_mode) as cat,
  case app.cat when 'BUILDING' then 0 when 'AUTOMOBILE' then 1 end as cat_code
from app left join gq using (eval_fold, grp) left join gl using (eval_fold) left join md using (eval_fold)""")
def i3_group_median_impute(spark, sf_dir):
    from foldwise.functions.features import map_values

    tr, app = applied(spark, sf_dir)
    g, glob = I.fit_imputer(tr, "grp", ["x1", "x2"], ["cat"], "fold", K)
    app = app.withColumn("cat_code", map_values("cat", {"BUILDING": 0, "AUTOMOBILE": 1}))
    out = I.apply_imputer(app, g, glob, "grp", ["x1", "x2"], ["cat"])
    return out.select("id", EVAL, "x1", "x2", "cat", "cat_code")


@register("i4_mean_impute_union", ops=["I4", "J8"], doubles=["x1"], sql=W(S.OBS) + """
select id, side, coalesce(x1, (select avg(x1) from obs)) as x1 from obs""")
def i4_mean_impute_union(spark, sf_dir):
    obs = observations(spark, sf_dir)
    both = (obs.where(F.col("side") == "train").select("id", "side", "x1")
            .unionByName(obs.where(F.col("side") == "test").select("id", "side", "x1")))
    return I.fill_from_own_table(both, mean_cols=["x1"])


GS_SQL = W(
    *S.obs_folds(),
    """gs as (
  select eval_fold, 'grp' as spec, grp, cast(null as integer) as flag, quantile_cont(x1, 0.5) as median, avg(x1) as mean, coalesce(stddev_samp(x1), 0) as std from fit where x1 is not null group by eval_fold, grp
  union all
  select eval_fold, 'flag', null, flag, quantile_cont(x1, 0.5), avg(x1), coalesce(stddev_samp(x1), 0) from fit where x1 is not null group by eval_fold, flag
  union all
  select eval_fold, 'grp_flag', grp, flag, quantile_cont(x1, 0.5), avg(x1), coalesce(stddev_samp(x1), 0) from fit where x1 is not null group by eval_fold, grp, flag)""",
    "gm as (select eval_fold, avg(x1) as global_mean from fit group by eval_fold)",
)
SPECS = [["grp"], ["flag"], ["grp", "flag"]]


@register("i5_group_stats_by_fold", ops=["I5"], doubles=["median", "mean", "std"],
          sql=GS_SQL + "select * from gs")
def i5_group_stats_by_fold(spark, sf_dir):
    _, tr, _ = split(spark, sf_dir)
    st = I.fit_group_stats(tr, "x1", SPECS, "fold", K)
    parts = []
    for spec in SPECS:
        t = st[tuple(spec)]
        parts.append(t.select(EVAL, F.lit("_".join(spec)).alias("spec"),
                              (F.col("grp") if "grp" in spec else F.lit(None).cast("int")).alias("grp"),
                              (F.col("flag") if "flag" in spec else F.lit(None).cast("int")).alias("flag"),
                              "median", "mean", "std"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _gs_feature_sql():
    cols = []
    joins = []
    for spec, alias in (("grp", "a"), ("flag", "b"), ("grp_flag", "c")):
        keys = " and ".join(f"app.{k} = {alias}.{k}" for k in spec.split("_"))
        joins.append(f"left join (select * from gs where spec = '{spec}') {alias} on app.eval_fold = {alias}.eval_fold and {keys}")
        sd = f"case when coalesce({alias}.std, 1) = 0 then 1 else coalesce({alias}.std, 1) end"
        cols.append(f"app.x1 - coalesce({alias}.median, gm.global_mean) as x1_diff_{spec}")
        cols.append(f"(app.x1 - coalesce({alias}.mean, gm.global_mean)) / {sd} as x1_z_{spec}")
    return ("select app.id, app.eval_fold, " + ", ".join(cols) +
            " from app left join gm on app.eval_fold = gm.eval_fold " + " ".join(joins))


@register("i6_group_stat_features", ops=["I6"],
          doubles=[f"x1_{k}_{s}" for s in ("grp", "flag", "grp_flag") for k in ("diff", "z")],
          sql=GS_SQL + _gs_feature_sql())
def i6_group_stat_features(spark, sf_dir):
    tr, app = applied(spark, sf_dir)
    st = I.fit_group_stats(tr, "x1", SPECS, "fold", K)
    out = I.apply_group_stats(app.select("id", EVAL, "grp", "flag", "x1"), "x1", st)
    return out.drop("grp", "flag", "x1")


@register("i7_frequency_encoding", ops=["I7"], doubles=["cat_freq"], sql=W(
    *S.obs_folds(),
    "fr as (select eval_fold, cat, count(*) * 1.0 / sum(count(*)) over (partition by eval_fold) as cat_freq from fit where cat is not null group by eval_fold, cat)",
) + "select id, app.eval_fold, coalesce(fr.cat_freq, 0) as cat_freq from app left join fr on app.eval_fold = fr.eval_fold and app.cat = fr.cat")
def i7_frequency_encoding(spark, sf_dir):
    tr, app = applied(spark, sf_dir)
    sh = I.fit_frequency(tr, "cat", "fold", K)
    return I.apply_frequency(app.select("id", EVAL, "cat"), "cat", sh).select("id", EVAL, "cat_freq")


@register("i8_range_position_in_group", ops=["I8"], doubles=["x2_pos_in_grp"], sql=W(
    *S.obs_folds(),
    "rg as (select eval_fold, grp, min(x2) as lo, max(x2) as hi from fit group by eval_fold, grp)",
) + """select id, app.eval_fold,
  greatest(0.0, least(1.0, (x2 - coalesce(lo, 0.0)) / case when coalesce(hi, 1.0) <> coalesce(lo, 0.0) then coalesce(hi, 1.0) - coalesce(lo, 0.0) else 1.0 end)) as x2_pos_in_grp
from app left join rg on app.eval_fold = rg.eval_fold and app.grp = rg.grp""")
def i8_range_position_in_group(spark, sf_dir):
    tr, app = applied(spark, sf_dir)
    rg = I.fit_range(tr, "x2", "grp", "fold", K)
    return I.apply_range(app.select("id", EVAL, "grp", "x2"), "x2", "grp", rg, "x2_pos_in_grp").select(
        "id", EVAL, "x2_pos_in_grp")


@register("i9_group_zscore", ops=["I9"], doubles=["x1_group_z"], sql=W(
    S.OBS,
    "st as (select c1, count(x1) as n, avg(x1) as m, stddev_samp(x1) as sd from obs where side = 'train' group by c1)",
) + """select id, case when n > 1 and sd > 0 then (x1 - m) / sd else 0.0 end as x1_group_z
from obs left join st using (c1)""")
def i9_group_zscore(spark, sf_dir):
    obs = observations(spark, sf_dir)
    tr = obs.where(F.col("side") == "train")
    return I.group_zscore(obs.select("id", "c1", "x1"), "x1", "c1", fit_on=tr).select("id", "x1_group_z")


@register("i10_above_group_q75", ops=["I10"], sql=W(
    S.OBS,
    "q as (select grp, quantile_cont(x2, 0.75) as q75 from obs where side = 'train' group by grp)",
) + "select id, coalesce(cast(x2 > q75 as integer), 0) as x2_above_q from obs left join q using (grp)")
def i10_above_group_q75(spark, sf_dir):
    obs = observations(spark, sf_dir)
    tr = obs.where(F.col("side") == "train")
    return I.above_group_quantile(obs.select("id", "grp", "x2"), "x2", "grp", 0.75, fit_on=tr,
                                  out="x2_above_q").select("id", "x2_above_q")
