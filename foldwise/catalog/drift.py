"""Registered queries: drift between the train and test sides."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.registry import register
from foldwise.operators import drift as D
from foldwise.sources.tables import observations, pseudo_score_expr

W = S.with_
NUM = ("x1", "x2", "c1")
CAT = ("cat", "grp", "flag")


def _sides(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return obs.where(F.col("side") == "train"), obs.where(F.col("side") == "test")


def _kolmogorov_sql(lam: str) -> str:
    # another way than the operator's: the dual series alone for moderate λ, the leading term beyond
    near = " + ".join(f"exp({-((2 * k - 1) ** 2) * math.pi ** 2 / 8!r} / (l * l))" for k in range(1, 60))
    tail = f"(case when l <= 0 then 1.0 when l < 6 then greatest(0.0, least(1.0, 1.0 - {math.sqrt(2 * math.pi)!r} / l * ({near}))) else 2.0 * exp(-2.0 * l * l) end)"
    return f"list_transform([{lam}], lambda l: {tail})[1]"


def _ks_sql() -> str:
    d = "\nunion all\n".join(
        f"select '{c}' as \"column\", cast({c} as double) as v, case when side = 'train' then 1 else 0 end as ia, "
        f"case when side = 'test' then 1 else 0 end as ib from obs where {c} is not null" for c in NUM)
    lam = "sqrt(n_a * n_b / (n_a + n_b)) * ks_stat"
    return W(
        S.OBS, f"d as ({d})",
        'vc as (select "column", v, cast(sum(ia) as double) as ca, cast(sum(ib) as double) as cb from d group by "column", v)',
        """c as (select *, sum(ca) over w as cum_a, sum(cb) over w as cum_b,
  sum(ca) over (partition by "column") as na, sum(cb) over (partition by "column") as nb
  from vc window w as (partition by "column" order by v rows between unbounded preceding and current row))""",
        """k as (select "column", max(abs(cum_a / na - cum_b / nb)) as ks_stat,
  sum(v * (abs((cum_a - ca) / na - (cum_b - cb) / nb) - abs(cum_a / na - cum_b / nb))) as wasserstein,
  any_value(na) as n_a, any_value(nb) as n_b,
  sum(v * cb) / any_value(nb) - sum(v * ca) / any_value(na) as mean_diff from c group by "column")""",
    ) + f"select *, {_kolmogorov_sql(lam)} as ks_p, cast({_kolmogorov_sql(lam)} < 0.05 as integer) as drift from k"


@register("d1_d3_ks_wasserstein", ops=["D1", "D2", "D3"],
          doubles=["ks_stat", "wasserstein", "n_a", "n_b", "mean_diff", "ks_p"], sql=_ks_sql())
def d1_d3_ks_wasserstein(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    return D.ks_wasserstein(a, b, NUM)


def _chi_sql() -> str:
    d = "\nunion all\n".join(
        f"select '{c}' as \"column\", coalesce(cast({c} as varchar), '_MISSING_') as v, side from obs" for c in CAT)
    e0 = "(r0 * (o0 + o1) / (r0 + r1))"
    e1 = "(r1 * (o0 + o1) / (r0 + r1))"

    def term(o, e):
        adj = f"(case when k - 1 = 1 then sign({e} - {o}) * least(0.5, abs({e} - {o})) else 0 end)"
        return f"power({o} + {adj} - {e}, 2) / {e}"
    return W(
        S.OBS, f"d as ({d})",
        """o as (select "column", v, cast(sum(case when side = 'train' then 1 else 0 end) as double) as o0,
  cast(sum(case when side = 'test' then 1 else 0 end) as double) as o1 from d group by "column", v)""",
        'm as (select "column", sum(o0) as r0, sum(o1) as r1, count(*) as k from o group by "column")',
    ) + f"""select "column", sum({term('o0', e0)} + {term('o1', e1)}) as chi2, cast(any_value(k) - 1 as integer) as dof,
  case when least(2, any_value(k)) - 1 > 0 then sqrt(sum({term('o0', e0)} + {term('o1', e1)}) / (any_value(r0 + r1) * (least(2, any_value(k)) - 1))) else 0.0 end as cramers_v
from o join m using ("column") group by "column\""""


@register("d4_d5_chi_square_cramers_v", ops=["D4", "D5"], doubles=["chi2", "cramers_v"], sql=_chi_sql())
def d4_d5_chi_square_cramers_v(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    return D.chi_square(a, b, CAT).drop("p_value")


@register("d6_drift_ranking", ops=["D6", "D2", "D4"])
def d6_drift_ranking(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    return D.drift_ranking(a, b, NUM, CAT)


@register("d8_importance_weights", ops=["D8"], sql=W(S.OBS) + f"""
select id, greatest(0.1, least(10.0, {S.pseudo_prob(2)} / (1.0 - {S.pseudo_prob(2)} + 0.01))) as weight from obs""")
def d8_importance_weights(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return obs.select("id", D.importance_weight(pseudo_score_expr(2)).alias("weight"))


@register("d9_weight_summary", ops=["D9"], doubles=["mean_w", "min_w", "max_w"], sql=W(
    S.OBS, f"w as (select *, greatest(0.1, least(10.0, {S.pseudo_prob(2)} / (1.0 - {S.pseudo_prob(2)} + 0.01))) as weight from obs where side = 'train')",
) + """select 'label' as by_col, label as key, avg(weight) as mean_w, min(weight) as min_w, max(weight) as max_w, count(*) as n from w group by label
union all select 'flag', flag, avg(weight), min(weight), max(weight), count(*) from w group by flag
union all select 'all', null, avg(weight), min(weight), max(weight), count(*) from w""")
def d9_weight_summary(spark, sf_dir):
    obs = observations(spark, sf_dir).where(F.col("side") == "train")
    w = obs.withColumn("weight", D.importance_weight(pseudo_score_expr(2)))
    out = D.weight_summary(w, "weight", [["label"], ["flag"], []])
    view = F.element_at(F.array(F.lit("label"), F.lit("flag"), F.lit("all")), F.col("_set") + 1)
    return out.select(view.alias("by_col"), F.coalesce("label", "flag").alias("key"), "mean_w", "min_w", "max_w", "n")
