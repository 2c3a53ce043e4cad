"""Registered queries: record × model error analysis on the holdout side."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.linkage import ENRICH_KEYS, ENRICH_SQL, HOLDOUT_SQL, holdout_labels
from foldwise.catalog.registry import register
from foldwise.operators import errors as R
from foldwise.operators import linkage as J
from foldwise.operators import profile as E
from foldwise.sources.tables import PSEUDO_MODELS, observations, pseudo_scores, registry

W = S.with_
MODELS = list(PSEUDO_MODELS)
N_MODELS = len(MODELS)

BASE = HOLDOUT_SQL + [
    S.scores("obs", "sc"),
    """corr as (select sc.id, sc.model, sc.prob, h.survived as label, cast(sc.prob >= 0.5 as integer) as pred,
  cast(cast(sc.prob >= 0.5 as integer) = h.survived as integer) as correct
  from sc join holdout h on sc.id = h.id where h.survived is not null)""",
    """rec as (select id, any_value(label) as label, cast(sum(correct) as integer) as correct_count, avg(prob) as avg_prob,
  string_agg(cast(correct as varchar), '' order by model) as pattern from corr group by id)""",
    "pat as (select pattern, count(*) as records from rec group by pattern)",
]


def _corr(spark, sf_dir):
    sc = pseudo_scores(observations(spark, sf_dir)).select("id", "model", "prob")
    return R.correctness(sc, holdout_labels(spark, sf_dir), label="survived")


def _records(spark, sf_dir, models=MODELS):
    return R.per_record(_corr(spark, sf_dir), models)


@register("r1_s8_correctness_matrix", ops=["R1", "S8", "S6"], doubles=["avg_prob"], sql=W(*BASE) + "select rec.id, rec.label, " + ", ".join(
    f"max(case when corr.model = '{m}' then corr.correct end) as {m}" for m in MODELS) +
    ", any_value(rec.correct_count) as correct_count, any_value(rec.avg_prob) as avg_prob from rec join corr on rec.id = corr.id group by rec.id, rec.label")
def r1_s8_correctness_matrix(spark, sf_dir):
    corr = _corr(spark, sf_dir)
    wide = corr.groupBy("id").pivot("model", MODELS).agg(F.first("correct"))
    rec = R.per_record(corr, MODELS).select("id", "label", "correct_count", "avg_prob")
    return rec.join(wide, "id")


@register("r2_r12_accuracy_fp_fn_by_model", ops=["R2", "R12", "X2"], doubles=["accuracy"], sql=W(*BASE) + """
select model, avg(correct) as accuracy, cast(sum(correct) as bigint) as n_correct, count(*) as n,
  cast(sum(case when pred = 1 and label = 0 then 1 else 0 end) as bigint) as fp,
  cast(sum(case when pred = 0 and label = 1 then 1 else 0 end) as bigint) as fn from corr group by model""")
def r2_r12_accuracy_fp_fn_by_model(spark, sf_dir):
    return R.accuracy_by_model(_corr(spark, sf_dir))


@register("r3_difficulty_distribution", ops=["R3"], doubles=["pct"], sql=W(*BASE) + """
select correct_count, count(*) as records, count(*) * 100.0 / sum(count(*)) over () as pct from rec group by correct_count""")
def r3_difficulty_distribution(spark, sf_dir):
    return R.difficulty_distribution(_records(spark, sf_dir))


@register("r4_hard_records", ops=["R4"], doubles=["avg_prob"], sql=W(*BASE) + f"""
select id, label, correct_count, avg_prob from rec where correct_count <= {N_MODELS // 2}""")
def r4_hard_records(spark, sf_dir):
    return R.hard_records(_records(spark, sf_dir), N_MODELS).select("id", "label", "correct_count", "avg_prob")


@register("r5_all_wrong_records", ops=["R5"], doubles=["avg_prob"], sql=W(*BASE) + """
select rec.id, rec.label, rec.avg_prob, holdout.confidence from rec join holdout on rec.id = holdout.id where correct_count = 0""")
def r5_all_wrong_records(spark, sf_dir):
    rec = _records(spark, sf_dir).where(F.col("correct_count") == 0)
    return rec.join(holdout_labels(spark, sf_dir).select("id", "confidence"), "id").select(
        "id", "label", "avg_prob", "confidence")


@register("r6_single_model_right", ops=["R6"], doubles=["avg_prob"], sql=W(*BASE) + """
select rec.id, rec.label, corr.model as winner, rec.avg_prob, holdout.confidence
from rec join corr on rec.id = corr.id and corr.correct = 1 join holdout on rec.id = holdout.id where rec.correct_count = 1""")
def r6_single_model_right(spark, sf_dir):
    corr = _corr(spark, sf_dir)
    one = R.one_correct(R.per_record(corr, MODELS), corr)
    return one.join(holdout_labels(spark, sf_dir).select("id", "confidence"), "id").select(
        "id", "label", "winner", "avg_prob", "confidence")


COMP_SQL = """comp as (
  select a.model as a, b.model as b, case when a.model = b.model then 0.0
    when sum(case when a.correct = 0 then 1 else 0 end) = 0 then 1.0
    else sum(case when a.correct = 0 and b.correct = 1 then 1 else 0 end) * 1.0 / sum(case when a.correct = 0 then 1 else 0 end) end as complementarity
  from corr a join corr b on a.id = b.id group by a.model, b.model)"""


@register("r7_complementarity", ops=["R7"], doubles=["complementarity"], sql=W(*BASE, COMP_SQL) + "select * from comp")
def r7_complementarity(spark, sf_dir):
    return R.complementarity(R.pattern_counts(_records(spark, sf_dir)), MODELS)


@register("r7_complementarity_unsorted_models", ops=["R7"], doubles=["complementarity"], sql=W(*BASE, COMP_SQL) + "select * from comp")
def r7_complementarity_unsorted_models(spark, sf_dir):
    models = ["m3", "m1", "m5", "m2", "m4"]
    return R.complementarity(R.pattern_counts(_records(spark, sf_dir, models)), models)


@register("r8_best_partner", ops=["R8"], doubles=["complementarity"], sql=W(*BASE, COMP_SQL) + """
select a, arg_min(b, (-complementarity, b)) as partner, max(complementarity) as complementarity from comp where a <> b group by a""")
def r8_best_partner(spark, sf_dir):
    comp = R.complementarity(R.pattern_counts(_records(spark, sf_dir)), MODELS)
    return R.best_partner(comp, MODELS)


@register("r9_pairwise_or_top10", ops=["R9"], doubles=["or_accuracy"], sql=W(*BASE) + """
select a.model as a, b.model as b, avg(case when a.correct = 1 or b.correct = 1 then 1.0 else 0.0 end) as or_accuracy
from corr a join corr b on a.id = b.id and a.model < b.model group by a.model, b.model
order by round(or_accuracy, 9) desc, a, b limit 10""")
def r9_pairwise_or_top10(spark, sf_dir):
    pr = R.pairwise_or(R.pattern_counts(_records(spark, sf_dir)), MODELS)
    # a top-k report: the limit is the feature (ranked on the pair table, 1 row per model pair)
    return pr.orderBy(F.round("or_accuracy", 9).desc(), "a", "b").limit(10)


@register("r10_pattern_clusters_top10", ops=["R10"], sql=W(*BASE) + f"""
select pattern, records, length(replace(pattern, '0', '')) as n_correct,
  list_filter([{', '.join(f"case when substr(pattern, {i + 1}, 1) = '0' then '{m}' end" for i, m in enumerate(MODELS))}], lambda x: x is not null) as wrong_models
from pat order by records desc, pattern limit 10""")
def r10_pattern_clusters_top10(spark, sf_dir):
    pat = R.pattern_counts(_records(spark, sf_dir))
    out = pat.select("pattern", "records", F.length(F.regexp_replace("pattern", "0", "")).alias("n_correct"),
                     R.wrong_models("pattern", MODELS).alias("wrong_models"))
    return out.orderBy(F.col("records").desc(), "pattern").limit(10)


@register("r11_accuracy_by_confidence", ops=["R11", "P19"], doubles=["mean_accuracy"], sql=W(*BASE) + """
select 'all' as level, count(distinct corr.id) as records, avg(correct) as mean_accuracy from corr
union all select 'sure', count(distinct corr.id), avg(correct) from corr join holdout h on corr.id = h.id where h.confidence in ('unique', 'all_agree')
union all select 'unique', count(distinct corr.id), avg(correct) from corr join holdout h on corr.id = h.id where h.confidence = 'unique'""")
def r11_accuracy_by_confidence(spark, sf_dir):
    return R.accuracy_by_confidence(_corr(spark, sf_dir), holdout_labels(spark, sf_dir))


@register("r13_hardest30_probabilities", ops=["R13"], doubles=["avg_prob"], sql=W(*BASE) + "select rec.id, rec.label, rec.correct_count, rec.avg_prob, " + ", ".join(
    f"max(case when corr.model = '{m}' then corr.prob end) as {m}" for m in MODELS) +
    """ from (select * from rec order by correct_count, id limit 30) rec join corr on rec.id = corr.id
group by rec.id, rec.label, rec.correct_count, rec.avg_prob""")
def r13_hardest30_probabilities(spark, sf_dir):
    corr = _corr(spark, sf_dir)
    hardest = R.per_record(corr, MODELS).orderBy("correct_count", "id").limit(30)  # top-k report
    wide = corr.join(hardest.select("id"), "id", "left_semi").groupBy("id").pivot("model", MODELS).agg(F.first("prob"))
    return hardest.select("id", "label", "correct_count", "avg_prob").join(wide, "id")


HARD_OBS = BASE + [f"hard as (select obs.* from obs where id in (select id from rec where correct_count <= {N_MODELS // 2}))"]


def _hard_obs(spark, sf_dir):
    hard = R.hard_records(_records(spark, sf_dir), N_MODELS).select("id")
    return observations(spark, sf_dir).join(hard, "id", "left_semi")


def _desc_sql(src, cols, by=None):
    b = f"{by}, " if by else ""
    return "\nunion all\n".join(f"""select {b}'{c}' as "column", count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std,
  cast(min({c}) as double) as min, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50,
  quantile_cont({c}, 0.75) as q75, cast(max({c}) as double) as max from {src} {('group by ' + by) if by else ''}""" for c in cols)


DESC = ["mean", "std", "min", "q25", "q50", "q75", "max"]


@register("r14_hard_case_numeric_profile", ops=["R14", "J2", "E5"], doubles=DESC,
          sql=W(*HARD_OBS) + _desc_sql("hard", ["x1", "x2"]))
def r14_hard_case_numeric_profile(spark, sf_dir):
    return E.describe_numeric(_hard_obs(spark, sf_dir), ["x1", "x2"])


@register("r14_hard_case_category_counts", ops=["R14", "E12"], sql=W(*HARD_OBS) + """
select 'flag' as feature, cast(flag as varchar) as value, count(*) as n from hard group by flag
union all select 'grp', cast(grp as varchar), count(*) from hard group by grp
union all select 'cat', cat, count(*) from hard where cat is not null group by cat""")
def r14_hard_case_category_counts(spark, sf_dir):
    h = _hard_obs(spark, sf_dir)
    parts = []
    for c in ("flag", "grp", "cat"):
        parts.append(h.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"), "n"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("r15_hard_case_profile_by_label", ops=["R15", "E15"], doubles=DESC,
          sql=W(*HARD_OBS) + _desc_sql("hard", ["x1", "x2"], "label"))
def r15_hard_case_profile_by_label(spark, sf_dir):
    return E.describe_numeric(_hard_obs(spark, sf_dir), ["x1", "x2"], by=["label"])


@register("r16_hard_vs_easy_positives", ops=["R16", "J2", "J3", "J8"], doubles=["x1_mean", "x2_mean", "male_share", "family_mean"],
          sql=W(*HARD_OBS, "pos as (select obs.*, case when id in (select id from hard) then 'hard' else 'easy' end as grp_name from obs where label = 1 and side = 'test' and id in (select id from rec))") + """
select grp_name, count(*) as n, avg(x1) as x1_mean, avg(x2) as x2_mean, avg(case when flag = 0 then 1.0 else 0.0 end) as male_share,
  avg(c1 + c2 + 1) as family_mean from pos group by grp_name""")
def r16_hard_vs_easy_positives(spark, sf_dir):
    rec = _records(spark, sf_dir)
    obs = observations(spark, sf_dir)
    pos = obs.where(F.col("label") == 1).join(rec.select("id"), "id", "left_semi")
    hard_ids = R.hard_records(rec, N_MODELS).select("id")
    hard = pos.join(hard_ids, "id", "left_semi").withColumn("grp_name", F.lit("hard"))
    easy = pos.join(hard_ids, "id", "left_anti").withColumn("grp_name", F.lit("easy"))
    both = hard.unionByName(easy)
    return both.groupBy("grp_name").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x1").alias("x1_mean"), F.avg("x2").alias("x2_mean"),
        F.avg((F.col("flag") == 0).cast("double")).alias("male_share"),
        F.avg(F.col("c1") + F.col("c2") + 1).alias("family_mean"))


@register("r17_hard_case_title_deck", ops=["R17", "J5", "P17"], sql=W(*HARD_OBS, *ENRICH_SQL[2:]) + """
select title, deck, count(*) as n, count(distinct ticket) as tickets
from e where matched = 1 and id in (select id from hard) group by title, deck""")
def r17_hard_case_title_deck(spark, sf_dir):
    h = _hard_obs(spark, sf_dir).select("id", *ENRICH_KEYS, "x2")
    e = J.enrich(h, registry(spark, sf_dir), ENRICH_KEYS, "x2", also=["ticket"]).where(F.col("matched") == 1)
    return e.groupBy("title", "deck").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_distinct("ticket").alias("tickets"))
