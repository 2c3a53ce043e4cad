"""Registered queries: ensembling over score columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.evaluation import SCORES_F, train_scores
from foldwise.catalog.registry import register
from foldwise.functions.columns import clip, logit, sigmoid
from foldwise.operators import blend as N
from foldwise.operators.metrics import auc
from foldwise.operators.profile import correlations
from foldwise.plans.joins import persisted
from foldwise.sources.tables import PSEUDO_MODELS, observations, seeded_scores

W = S.with_
MODELS = list(PSEUDO_MODELS)
R_MODELS = [f"r_{m}" for m in MODELS]

# fixed parameters of the searches
GATE_THRESHOLDS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30)
GATE_ALPHAS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
PAIR_WEIGHTS = tuple(i * 0.05 for i in range(21))
TWO_GROUP_WEIGHTS = (0.1, 0.2, 0.3, 0.4, 0.5)
VOTE_WEIGHTS = {"m1": 1.0, "m2": 2.0, "m3": 1.0, "m4": 3.0, "m5": 0.5}


def _rank_sql(src: str = "scores", name: str = "rk") -> str:
    return f"""{name} as (select id, model, ((rank() over (partition by model order by prob) - 1)
  + (count(*) over (partition by model, prob) + 1) / 2.0) / count(*) over (partition by model) as prob from {src})"""


BASE_SQL = [
    SCORES_F.removeprefix("with ").rstrip("\n"),
    _rank_sql(),
    S.wide_sql("scores", "id, label, fold", name="wd"),
    S.wide_sql("rk", "id", name="wr"),
    """base as (select wd.*, wr.m1 as r_m1, wr.m2 as r_m2, wr.m3 as r_m3, wr.m4 as r_m4, wr.m5 as r_m5,
  (wd.m1 + wd.m2 + wd.m3 + wd.m4 + wd.m5) / 5.0 as vote,
  (wr.m1 + wr.m2 + wr.m3 + wr.m4 + wr.m5) / 5.0 as rank_avg from wd join wr on wd.id = wr.id)""",
]


def _base(spark, sf_dir):
    sc = train_scores(spark, sf_dir)
    rk = N.percentile_ranks(sc, ["model"], "prob", "rank_pct")
    return _means(N.wide(rk, MODELS, keys=("id", "label", "fold"), more={"r_": "rank_pct"}))


def _means(wide):
    return wide.withColumn("vote", N.mean_expr(MODELS)).withColumn("rank_avg", N.mean_expr(R_MODELS))


def _long(wide, name, probs):
    """(name, label, prob): a row of ``wide`` once for each of ``probs``. A union would read ``wide`` as often, in one task."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias(name), prob.alias("prob")) for k, prob in probs.items()])).alias("_p")
    return wide.select("label", each).select(f"_p.{name}", "label", "_p.prob")


def _logit_sql(cols) -> str:
    terms = " + ".join(f"ln(greatest(0.001, least(0.999, {c})) / (1.0 - greatest(0.001, least(0.999, {c}))))" for c in cols)
    return f"(1.0 / (1.0 + exp(-(({terms}) / {float(len(cols))}))))"


@register("n1_soft_vote", ops=["N1", "S6"], doubles=["prob"], sql=W(SCORES_F.removeprefix("with ").rstrip("\n")) + """
select id, avg(prob) as prob from scores group by id""")
def n1_soft_vote(spark, sf_dir):
    return N.soft_vote(train_scores(spark, sf_dir))


@register("n2_weighted_vote", ops=["N2"], doubles=["prob"], sql=W(SCORES_F.removeprefix("with ").rstrip("\n")) + """
select id, sum(w * prob) / sum(w) as prob from scores join (values """ + ", ".join(
    f"('{m}', cast({w!r} as double))" for m, w in VOTE_WEIGHTS.items()) + """) v(model, w) using (model) group by id""")
def n2_weighted_vote(spark, sf_dir):
    return N.soft_vote(train_scores(spark, sf_dir), VOTE_WEIGHTS)


@register("n3_vote_subsets_auc", ops=["N3", "N1", "X4"], doubles=["auc", "n_pos", "n_neg"], sql=W(
    *BASE_SQL,
    "v as (select 'all5' as subset, label, vote as prob from base union all select 'first4', label, (m1 + m2 + m3 + m4) / 4.0 from base)",
) + "select * from " + S.auc_sql("v", ["subset"]) + " t")
def n3_vote_subsets_auc(spark, sf_dir):
    b = _base(spark, sf_dir)
    return auc(_long(b, "subset", {"all5": F.col("vote"), "first4": N.mean_expr(MODELS[:4])}), "label", "prob", ["subset"])


@register("n4_rank_average", ops=["N4"], sql=W(*BASE_SQL) + "select id, rank_avg from base")
def n4_rank_average(spark, sf_dir):
    return _base(spark, sf_dir).select("id", "rank_avg")


@register("n5_fold_local_rank_auc", ops=["N5", "X4"], doubles=["auc_vote", "auc_rank"], sql=W(
    *BASE_SQL,
    """fr as (select id, model, ((rank() over (partition by fold, model order by prob) - 1)
  + (count(*) over (partition by fold, model, prob) + 1) / 2.0) / count(*) over (partition by fold, model) as prob from scores)""",
    S.wide_sql("fr", "id", name="wf"),
    "fb as (select base.fold, base.label, base.vote, (wf.m1 + wf.m2 + wf.m3 + wf.m4 + wf.m5) / 5.0 as frank from base join wf on base.id = wf.id)",
    "av as (select fold, label, vote as prob from fb)", "ar as (select fold, label, frank as prob from fb)",
) + "select a.fold, a.auc as auc_vote, r.auc as auc_rank from " + S.auc_sql("av", ["fold"]) + " a join " +
    S.auc_sql("ar", ["fold"]) + " r on a.fold = r.fold")
def n5_fold_local_rank_auc(spark, sf_dir):
    sc = train_scores(spark, sf_dir)
    rk = N.percentile_ranks(N.percentile_ranks(sc, ["model"], "prob", "rank_pct"), ["fold", "model"], "prob", "fold_pct")
    b = _means(N.wide(rk, MODELS, keys=("id", "label", "fold"), more={"r_": "rank_pct", "f_": "fold_pct"}))
    b = persisted(b.withColumn("frank", N.mean_expr([f"f_{m}" for m in MODELS])).select("fold", "label", "vote", "frank"))
    av = auc(b, "label", "vote", ["fold"]).select("fold", F.col("auc").alias("auc_vote"))
    ar = auc(b, "label", "frank", ["fold"]).select("fold", F.col("auc").alias("auc_rank"))
    return av.join(ar, "fold")


@register("n6_raw_and_rank_correlations", ops=["N6", "E18"], doubles=["corr"], sql=W(*BASE_SQL) + "\nunion all\n".join(
    f"select '{k}' as kind, '{a}' as a, '{b}' as b, corr({p}{a}, {p}{b}) as corr from base"
    for k, p in (("raw", ""), ("rank", "r_")) for i, a in enumerate(MODELS) for b in MODELS[i + 1:]))
def n6_raw_and_rank_correlations(spark, sf_dir):
    b = _base(spark, sf_dir)
    raw = correlations(b, MODELS).select(F.lit("raw").alias("kind"), "a", "b", "corr")
    rb = b.select(*[F.col(f"r_{m}").alias(m) for m in MODELS])
    rk = correlations(rb, MODELS).select(F.lit("rank").alias("kind"), "a", "b", "corr")
    return raw.unionByName(rk)


@register("n10_multi_seed_average", ops=["N10"], doubles=["prob"], sql=W(S.OBS, S.seeded_scores("obs", "ss")) + """
select id, model, avg(prob) as prob from ss where side = 'train' group by id, model""")
def n10_multi_seed_average(spark, sf_dir):
    ss = seeded_scores(observations(spark, sf_dir)).where(F.col("side") == "train")
    return ss.groupBy("id", "model").agg(F.avg("prob").alias("prob"))


@register("n12_logit_blend", ops=["N12"], doubles=["prob"], sql=W(*BASE_SQL) + f"select id, {_logit_sql(MODELS)} as prob from base")
def n12_logit_blend(spark, sf_dir):
    return _base(spark, sf_dir).select("id", N.logit_blend(MODELS, 0.001).alias("prob"))


GRID3 = N.simplex_grid(3, 0.05)
BLEND3 = ["vote", "rank_avg", "m5"]


def _grid_sql(grid, cols, extra="") -> str:
    score = " + ".join(f"g.w{i} * b.{c}" for i, c in enumerate(cols))
    return f"gs as (select g.*, b.label, {score} as prob {extra} from base b cross join {S.grid_values(grid)})"


@register("n13_simplex_grid_top10", ops=["N13"], doubles=["auc"], sql=W(*BASE_SQL, _grid_sql(GRID3, BLEND3)) +
          f"""select t.grid_id, g.w0, g.w1, g.w2, t.auc from {S.auc_sql('gs', ['grid_id'])} t
join {S.grid_values(GRID3)} on t.grid_id = g.grid_id order by round(t.auc, 9) desc, t.grid_id limit 10""")
def n13_simplex_grid_top10(spark, sf_dir):
    res = N.grid_top(_base(spark, sf_dir), BLEND3, GRID3, 10)
    return res.select("grid_id", "w0", "w1", "w2", "auc").orderBy(F.round("auc", 9).desc(), "grid_id").limit(10)


@register("n14_refined_grid_top10", ops=["N14", "N13"])
def n14_refined_grid_top10(spark, sf_dir):
    base = _base(spark, sf_dir)
    best = N.grid_top(base, BLEND3, GRID3, 1).first()  # one row: the coarse optimum
    fine = N.refine_grid([best["w0"], best["w1"], best["w2"]], 0.01, 0.05)
    res = N.grid_top(base, BLEND3, fine, 10)
    return res.orderBy(F.round("auc", 9).desc(), "grid_id").limit(10)


LINEAR = "(0.4 * vote + 0.3 * m5 + 0.3 * rank_avg)"


@register("n15_gated_blend_grid", ops=["N15"], doubles=["auc"], sql=W(
    *BASE_SQL,
    "tg as (select * from (values " + ", ".join(f"(cast({t!r} as double), cast({a!r} as double))" for t in GATE_THRESHOLDS for a in GATE_ALPHAS) + ") v(threshold, alpha))",
    f"""gs as (select tg.threshold, tg.alpha, b.label, case when abs(b.m5 - b.rank_avg) > tg.threshold
  then tg.alpha * b.rank_avg + (1.0 - tg.alpha) * b.vote else {LINEAR.replace('vote', 'b.vote').replace('m5', 'b.m5').replace('rank_avg', 'b.rank_avg')} end as prob from base b cross join tg)""",
) + "select threshold, alpha, auc from " + S.auc_sql("gs", ["threshold", "alpha"]) + " t")
def n15_gated_blend_grid(spark, sf_dir):
    b = _base(spark, sf_dir)
    lin = F.lit(0.4) * F.col("vote") + F.lit(0.3) * F.col("m5") + F.lit(0.3) * F.col("rank_avg")
    return N.gated_auc(b, "m5", "rank_avg", "vote", lin, GATE_THRESHOLDS, GATE_ALPHAS)


GRID_TENTH = N.simplex_grid(3, 0.1)
FIXED = (0.4, 0.3, 0.3)
BLEND_SEEDS = (0, 1, 2, 3, 4)


@register("n16_blend_stability_over_seeds", ops=["N16", "N18"], doubles=["auc_fixed", "auc_best"], sql=W(
    S.OBS, S.seeded_scores("obs", "ss", BLEND_SEEDS),
    "sw as (select seed, id, label, " + ", ".join(f"max(case when model = 'm{k}' then prob end) as m{k}" for k in (3, 4, 5)) +
    " from ss where side = 'train' group by seed, id, label)",
    "gs as (select g.grid_id, g.w0, g.w1, g.w2, sw.seed, sw.label, g.w0 * sw.m3 + g.w1 * sw.m4 + g.w2 * sw.m5 as prob from sw cross join " + S.grid_values(GRID_TENTH) + ")",
    "ga as (select t.*, g.w0, g.w1, g.w2 from " + S.auc_sql("gs", ["seed", "grid_id"]) + " t join " + S.grid_values(GRID_TENTH) + " on t.grid_id = g.grid_id)",
) + f"""select seed, max(case when w0 = {FIXED[0]!r} and w1 = {FIXED[1]!r} and abs(w2 - {FIXED[2]!r}) < 1e-9 then auc end) as auc_fixed,
  max(auc) as auc_best, arg_min(grid_id, (-round(auc, 9), grid_id)) as best_grid_id from ga group by seed""")
def n16_blend_stability_over_seeds(spark, sf_dir):
    ss = seeded_scores(observations(spark, sf_dir), BLEND_SEEDS).where(F.col("side") == "train")
    sw = N.wide(ss, ["m3", "m4", "m5"], keys=("seed", "id", "label"))
    at = [g for g, w in enumerate(GRID_TENTH) if all(abs(x - y) < 1e-9 for x, y in zip(w, FIXED))]
    res = N.grid_top(sw, ["m3", "m4", "m5"], GRID_TENTH, 1, extra_keys=["seed"], always=at)
    fixed = (F.col("w0") == FIXED[0]) & (F.col("w1") == FIXED[1]) & (F.abs(F.col("w2") - FIXED[2]) < 1e-9)
    return res.groupBy("seed").agg(
        F.max(F.when(fixed, F.col("auc"))).alias("auc_fixed"), F.max("auc").alias("auc_best"),
        F.min_by("grid_id", F.struct(-F.round("auc", 9), F.col("grid_id"))).alias("best_grid_id"))


@register("n17_pairwise_blend_grid", ops=["N17"], doubles=["auc"], sql=W(
    *BASE_SQL,
    "pg as (" + "\nunion all\n".join(f"select '{a}' as a, '{b}' as b, cast({w!r} as double) as w, label, cast({w!r} as double) * {a} + (1.0 - cast({w!r} as double)) * {b} as prob from base"
                                      for i, a in enumerate(MODELS) for b in MODELS[i + 1:] for w in PAIR_WEIGHTS) + ")",
) + "select a, b, w, auc from " + S.auc_sql("pg", ["a", "b", "w"]) + " t")
def n17_pairwise_blend_grid(spark, sf_dir):
    return N.pair_grid_auc(_base(spark, sf_dir), MODELS, PAIR_WEIGHTS)


@register("n18_three_way_grid_step_tenth", ops=["N18"], doubles=["auc"], sql=W(*BASE_SQL, _grid_sql(GRID_TENTH, ["m3", "m4", "m5"])) +
          f"""select t.grid_id, g.w0, g.w1, g.w2, t.auc from {S.auc_sql('gs', ['grid_id'])} t join {S.grid_values(GRID_TENTH)} on t.grid_id = g.grid_id""")
def n18_three_way_grid_step_tenth(spark, sf_dir):
    return N.grid_auc(_base(spark, sf_dir), ["m3", "m4", "m5"], GRID_TENTH).select("grid_id", "w0", "w1", "w2", "auc")


def _model_auc_sql() -> str:
    parts = "\nunion all\n".join(f"select '{m}' as model, label, {m} as prob from base" for m in MODELS)
    return f"ml as ({parts})"


@register("n20_softmax_topk_averages", ops=["N20", "N19"], doubles=["equal", "softmax", "top3", "top5", "top10"], sql=W(
    *BASE_SQL, _model_auc_sql(),
    "ma as (select * from " + S.auc_sql("ml", ["model"]) + " t)",
    "mx as (select max(auc) as mx from ma)",
    "sw as (select model, exp(50.0 * (auc - mx)) / sum(exp(50.0 * (auc - mx))) over () as w from ma, mx)",
    "tk as (select model, row_number() over (order by round(auc, 9) desc, model) as rn from ma)",
    "lg as (select id, model, prob from scores)",
) + """select lg.id, avg(lg.prob) as equal, sum(sw.w * lg.prob) / sum(sw.w) as softmax,
  avg(case when rn <= 3 then lg.prob end) as top3, avg(case when rn <= 5 then lg.prob end) as top5, avg(case when rn <= 10 then lg.prob end) as top10
from lg join sw on lg.model = sw.model join tk on lg.model = tk.model group by lg.id""")
def n20_softmax_topk_averages(spark, sf_dir):
    sc = train_scores(spark, sf_dir)
    ma = auc(sc, "label", "prob", ["model"])
    sw = N.softmax_weights(ma, 50.0).select("model", F.col("weight").alias("w"))
    ranked = [r["model"] for r in ma.orderBy(F.round("auc", 9).desc(), "model").limit(10).collect()]  # model names
    j = sc.join(F.broadcast(sw), "model")  # one row per model
    return j.groupBy("id").agg(
        F.avg("prob").alias("equal"), (F.sum(F.col("w") * F.col("prob")) / F.sum("w")).alias("softmax"),
        *[F.avg(F.when(F.col("model").isin(*ranked[:k]), F.col("prob"))).alias(f"top{k}") for k in (3, 5, 10)])


@register("n21_two_group_blend_sweep", ops=["N21"], doubles=["auc"], sql=W(
    *BASE_SQL, "tg as (select label, (m1 + m2) / 2.0 as ga, (m3 + m4 + m5) / 3.0 as gb from base)",
    "gs as (select g.grid_id, label, g.w0 * ga + g.w1 * gb as prob from tg cross join " + S.grid_values([(w, 1.0 - w) for w in TWO_GROUP_WEIGHTS]) + ")",
) + "select t.grid_id, g.w0, t.auc from " + S.auc_sql("gs", ["grid_id"]) + " t join " + S.grid_values([(w, 1.0 - w) for w in TWO_GROUP_WEIGHTS]) + " on t.grid_id = g.grid_id")
def n21_two_group_blend_sweep(spark, sf_dir):
    b = _base(spark, sf_dir).withColumn("ga", N.mean_expr(["m1", "m2"])).withColumn("gb", N.mean_expr(["m3", "m4", "m5"]))
    return N.grid_auc(b, ["ga", "gb"], [(w, 1.0 - w) for w in TWO_GROUP_WEIGHTS]).select("grid_id", "w0", "auc")


def _random_weights(n: int = 50, k: int = 4, seed: int = 42) -> list[tuple[float, ...]]:
    rng = random.Random(seed)
    return [tuple(round(rng.uniform(0.0, 2.0), 6) for _ in range(k)) for _ in range(n)]


RANDOM_W = _random_weights()


@register("h4_random_vote_weight_search", ops=["H4"], doubles=["auc"], sql=W(*BASE_SQL, _grid_sql(RANDOM_W, MODELS[:4])) +
          f"""select t.grid_id, g.w0, g.w1, g.w2, g.w3, t.auc, cast(rank() over (order by round(t.auc, 9) desc, t.grid_id) as integer) as trial_rank
from {S.auc_sql('gs', ['grid_id'])} t join {S.grid_values(RANDOM_W)} on t.grid_id = g.grid_id""")
def h4_random_vote_weight_search(spark, sf_dir):
    from pyspark.sql import Window

    res = N.grid_auc(_base(spark, sf_dir), MODELS[:4], RANDOM_W)
    # 50 trial rows: a one-partition ranking window over the trial table is bounded
    return res.withColumn("trial_rank", F.rank().over(Window.orderBy(F.round("auc", 9).desc(), "grid_id")))


@register("x20_prediction_agreement", ops=["X20"], doubles=["corr", "max_abs_diff"], sql=W(*BASE_SQL) + f"""
select corr(vote, {_logit_sql(MODELS)}) as corr, max(abs(vote - {_logit_sql(MODELS)})) as max_abs_diff from base""")
def x20_prediction_agreement(spark, sf_dir):
    b = _base(spark, sf_dir).withColumn("lg", N.logit_blend(MODELS, 0.001))
    return b.agg(F.corr("vote", "lg").alias("corr"), F.max(F.abs(F.col("vote") - F.col("lg"))).alias("max_abs_diff"))


@register("x21_blend_method_comparison", ops=["X21", "X4", "X5"], doubles=["auc", "brier", "auc_vs_vote"], sql=W(
    *BASE_SQL,
    f"mt as (select 'vote' as method, label, vote as prob from base union all select 'rank', label, rank_avg from base union all select 'logit', label, {_logit_sql(MODELS)} from base union all select 'm5', label, m5 from base)",
    "a as (select * from " + S.auc_sql("mt", ["method"]) + " t)",
    "br as (select method, avg((prob - label) * (prob - label)) as brier from mt group by method)",
) + """select a.method, a.auc, br.brier, a.auc - (select auc from a where method = 'vote') as auc_vs_vote,
  cast(rank() over (order by round(a.auc, 9) desc, a.method) = 1 as integer) as is_best from a join br on a.method = br.method""")
def x21_blend_method_comparison(spark, sf_dir):
    from pyspark.sql import Window

    b = _base(spark, sf_dir).withColumn("lg", N.logit_blend(MODELS, 0.001))
    b = persisted(b.select("label", "vote", "rank_avg", "lg", "m5"))
    mt = _long(b, "method", {"vote": F.col("vote"), "rank": F.col("rank_avg"), "logit": F.col("lg"), "m5": F.col("m5")})
    a = auc(mt, "label", "prob", ["method"]).select("method", "auc")
    br = N.brier(mt, "label", "prob", ["method"])
    j = a.join(br, "method")
    vote_auc = j.where(F.col("method") == "vote").select(F.col("auc").alias("_va"))
    j = j.withColumn("_k", F.lit(0)).join(F.broadcast(vote_auc.withColumn("_k", F.lit(0))), "_k").drop("_k")
    w = Window.orderBy(F.round("auc", 9).desc(), "method")  # four method rows
    return j.select("method", "auc", "brier", (F.col("auc") - F.col("_va")).alias("auc_vs_vote"),
                    (F.rank().over(w) == 1).cast("int").alias("is_best"))


__all__ = ["clip", "logit", "sigmoid"]
