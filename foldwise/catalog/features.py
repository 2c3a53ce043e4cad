"""Registered queries: scalar features, binning, one-hot, regex extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.common import K, applied
from foldwise.catalog.registry import register
from foldwise.functions import features as P
from foldwise.operators.foldstats import EVAL, fold_quantiles_multi
from foldwise.sources.tables import observations, pseudo_score_expr, table

W = S.with_
GRPS = (1, 2, 3, 4, 5)


def _scalar_sql() -> str:
    fam = "(c1 + c2 + 1)"
    cols = [
        "case cat when 'BUILDING' then 0 when 'AUTOMOBILE' then 1 end as cat_code",
        f"{fam} as family_size", f"cast({fam} = 1 as integer) as is_alone",
        "ln(1 + x2) as log_x2", f"x2 / {fam} as x2_per_person", "grp * 10 + flag as grp_flag",
        "cast(x1 is null as integer) as x1_missing", "cast(cat is null as integer) as cat_missing",
        "case when x1 >= 0 and x1 <= 12 then 0 when x1 > 12 and x1 <= 18 then 1 when x1 > 18 and x1 <= 35 then 2 "
        "when x1 > 35 and x1 <= 60 then 3 when x1 > 60 and x1 <= 100 then 4 else 2 end as x1_bin",
        "x1 * grp as x1_grp", "x2 * grp as x2_grp", "ln(1 + x2) / grp as log_x2_per_grp",
        f"{fam} * flag as family_flag", f"cast({fam} = 1 as integer) * flag as alone_flag",
    ]
    for g in GRPS:
        cols.append(f"cast(flag = 1 and grp = {g} as integer) as flag1_{g}")
        cols.append(f"cast(flag = 0 and grp = {g} as integer) as flag0_{g}")
    cols += [
        "x1 * x1 as x1_sq", "x2 * x2 as x2_sq", "x1 * x2 as x1_x2",
        "coalesce(cast(x1 <= 12 as integer), 0) as is_child",
        "coalesce(cast(flag = 1 and c2 > 0 and x1 > 18 as integer), 0) as is_mother",
        "cast(x2 = 0 as integer) as x2_zero",
        f"cast({fam} between 2 and 4 as integer) as family_small",
        f"cast({fam} >= 5 as integer) as family_large",
        f"coalesce(cast(x1 <= 12 and {fam} > 1 as integer), 0) as child_with_family",
        f"cast(flag = 0 and {fam} > 1 as integer) as male_with_family",
        "coalesce(cast(flag = 0 and x1 < 15 as integer), 0) as young_male",
        "cast(flag = 0 and grp <= 2 as integer) as male_upper_class",
        "cast(flag = 0 and c2 > 0 as integer) as male_with_children",
        "coalesce(cast(x1 >= 60 as integer), 0) as is_elderly",
        f"cast(grp = 3 and {fam} >= 2 and {fam} <= 4 as integer) as small_family_3rd",
        "x1 * cast(flag = 0 as integer) as age_x_male", "x1 * (1 - cast(flag = 0 as integer)) as age_x_female",
        f"cast({S.pseudo_prob(3)} >= 0.5 as integer) as pred_m3",
    ]
    return W(S.OBS) + "select id, " + ",\n  ".join(cols) + " from obs"


SCALAR_DOUBLES = ["log_x2", "x2_per_person", "x1_grp", "x2_grp", "log_x2_per_grp", "x1_sq", "x2_sq",
                  "x1_x2", "age_x_male", "age_x_female"]


@register("p_scalar_features", ops=["P1", "P4", "P5", "P8", "P9", "P12", "P13", "P14", "P15", "P20"],
          sql=_scalar_sql())
def p_scalar_features(spark, sf_dir):
    obs = observations(spark, sf_dir)
    base = obs.select("*", *P.base_derived("c1", "c2", "x2", "grp", "flag"))
    base = base.withColumnRenamed("grp_flag", "grp_flag")
    cols = [
        P.map_values("cat", {"BUILDING": 0, "AUTOMOBILE": 1}).alias("cat_code"),
        "family_size", "is_alone", "log_x2", "x2_per_person", "grp_flag",
        *P.missing_flags(["x1", "cat"]),
        P.rule_bin("x1").alias("x1_bin"),
        *P.interactions("x1", "x2", "grp", "flag", GRPS, "log_x2", "family_size", "is_alone"),
        *P.polynomial("x1", "x2"),
        *P.domain_flags("x1", "flag", "c2", "x2", "family_size"),
        *P.exception_flags("x1", "flag", "grp", "c1", "c2"),
        P.threshold(pseudo_score_expr(3), 0.5).alias("pred_m3"),
    ]
    out = base.select("id", *cols)
    return (out.withColumnRenamed("log_x2_per_grp", "log_x2_per_grp")
            .withColumnRenamed("x2_zero", "x2_zero"))


CATS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register("p2_one_hot_train_levels", ops=["P2", "P3", "P6", "P22"], sql=W(S.OBS) + "select id, " + ", ".join(
    f"coalesce(cast(cat = '{c}' as integer), 0) as cat_{c}" for c in CATS) + ", 0 as cat_UNSEEN from obs")
def p2_one_hot_train_levels(spark, sf_dir):
    obs = observations(spark, sf_dir)
    levels = P.learn_levels(obs.where(F.col("side") == "train"), "cat")
    wide = P.dummies(obs.select("id", "cat"), ["cat"], levels={"cat": levels})
    # fixed output schema from the fit: a level the fit never saw is a zero column
    return P.select_or_zero(wide, ["id", *[f"cat_{c}" for c in levels], "cat_UNSEEN"])


@register("p10_p11_quantile_bins", ops=["P10", "P11"], sql=W(
    *S.obs_folds(),
    "qe as (select eval_fold, list_sort(list_distinct(quantile_cont(x2, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) as e from fit group by eval_fold)",
    "qi as (select eval_fold, list_slice(e, 2, len(e) - 1) as inner_edges from qe)",
) + """select id, app.eval_fold, case when x2 is null then -1 else len(list_filter(inner_edges, lambda e: e < x2)) end as x2_qbin,
  case when x1 is null then -1 else len(list_filter(inner_edges, lambda e: e < x1 * 10)) end as x1_qbin
from app join qi on app.eval_fold = qi.eval_fold""")
def p10_p11_quantile_bins(spark, sf_dir):
    tr, app = applied(spark, sf_dir)
    qs = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
    q = fold_quantiles_multi(tr, ["x2"], [], qs, "fold", K)
    edges = F.array_sort(F.array_distinct(F.array(*[F.col(f"x2_q{int(x * 100):02d}") for x in qs])))
    inner = q.select(EVAL, F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0))).alias("inner_edges"))
    j = app.select("id", EVAL, "x1", "x2").join(F.broadcast(inner), EVAL)  # one row per fold
    return j.select("id", EVAL, P.apply_edges("x2", F.col("inner_edges")).alias("x2_qbin"),
                    P.apply_edges(F.col("x1") * 10, F.col("inner_edges")).alias("x1_qbin"))


@register("p17_title_and_initial", ops=["P17"], sql="""
select doc_id, nullif(regexp_extract(text, ', ([\\p{L}\\p{N}_]+)\\.', 1), '') as title,
  substr(source, 1, 1) as initial from documents""")
def p17_title_and_initial(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", P.title_of("text", r", ([\p{L}\p{N}_]+)\.").alias("title"),
                    P.first_letter("source").alias("initial"))


@register("p18_shared_key_group_size", ops=["P18"], sql="""
select o_orderkey as id, count(*) over (partition by o_custkey) as group_size from orders""")
def p18_shared_key_group_size(spark, sf_dir):
    from foldwise.plans.joins import join_on_keys

    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    sizes = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("group_size"))
    return join_on_keys(o, sizes, ["o_custkey"], "left").select("id", "group_size")


@register("p21_named_feature_subsets", ops=["P21", "P6", "P7"],
          sql=W(S.OBS) + """select id, 'base' as subset, grp, flag, x1, x2, cast(null as double) as log_x2, cast(null as double) as x2_per_person from obs
union all select id, 'derived', 0, 0, cast(null as double), cast(null as double), ln(1 + x2), x2 / (c1 + c2 + 1) from obs""")
def p21_named_feature_subsets(spark, sf_dir):
    obs = observations(spark, sf_dir).select("*", *P.base_derived("c1", "c2", "x2", "grp", "flag"))
    subsets = {"base": ["grp", "flag", "x1", "x2", "missing_col"], "derived": ["log_x2", "x2_per_person"]}
    cols = ["grp", "flag", "x1", "x2", "log_x2", "x2_per_person"]
    parts = []
    for name, wanted in subsets.items():
        keep = P.feature_subset(obs.columns, wanted)
        sel = P.select_or_zero(obs.select("id", *keep), ["id", *keep])
        full = sel.select("id", F.lit(name).alias("subset"),
                          *[(F.col(c) if c in keep else F.lit(None if c in ("x1", "x2", "log_x2", "x2_per_person") else 0)
                             .cast("double" if c in ("x1", "x2", "log_x2", "x2_per_person") else "int")).alias(c)
                            for c in cols])
        parts.append(full)
    return parts[0].unionByName(parts[1])
