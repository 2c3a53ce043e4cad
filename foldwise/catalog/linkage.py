"""Registered queries: joins and record linkage (J1-J8) plus the holdout label file they produce."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.registry import register
from foldwise.operators import linkage as J
from foldwise.sources.tables import observations, pseudo_scores, registry

W = S.with_
KEYS5 = ["grp", "flag", "c1", "c2", "cat"]
KEYS7 = ["grp", "flag", "c1", "c2", "cat", "x1b", "x2b"]
ENRICH_KEYS = ["grp", "flag", "c1", "c2"]
TITLE_RE = r", ([\p{L}\p{N}_]+)\."


def _bands(df):
    return df.withColumn("x1b", F.floor(F.col("x1") / 10)).withColumn("x2b", F.floor(F.col("x2") / 25))


def holdout_labels(spark, sf_dir):
    """(id, survived, confidence, n_candidates) for the test side, linked to the registry."""
    te = _bands(observations(spark, sf_dir).where(F.col("side") == "test"))
    reg = _bands(registry(spark, sf_dir))
    return J.link_labels(te, reg, KEYS7, label="label")


HOLDOUT_SQL = [
    S.OBS, S.REGISTRY,
    "te as (select *, floor(x1 / 10) as x1b, floor(x2 / 25) as x2b from obs where side = 'test')",
    """cand as (select grp, flag, c1, c2, cat, floor(x1 / 10) as x1b, floor(x2 / 25) as x2b, count(*) as n,
  count(distinct label) as nl, min(label) as l from reg group by all)""",
    """holdout as (select te.id, case when cand.n = 1 or cand.nl = 1 then cand.l end as survived,
  case when cand.n is null then 'unmatched' when cand.n = 1 then 'unique' when cand.nl = 1 then 'all_agree' else 'conflicting' end as confidence,
  cast(coalesce(cand.n, 0) as bigint) as n_candidates
  from te left join cand on te.grp = cand.grp and te.flag = cand.flag and te.c1 = cand.c1 and te.c2 = cand.c2
   and te.cat is not distinct from cand.cat and te.x1b is not distinct from cand.x1b and te.x2b is not distinct from cand.x2b)""",
]


@register("j7_holdout_linkage", ops=["J7", "S4"], sql=W(*HOLDOUT_SQL) + "select * from holdout")
def j7_holdout_linkage(spark, sf_dir):
    return holdout_labels(spark, sf_dir)


@register("j1_j6_scores_join_labels", ops=["J1", "J6", "S6"], sql=W(*HOLDOUT_SQL, S.scores("obs", "sc")) + """
select sc.id, sc.model, sc.prob, holdout.survived, holdout.confidence
from sc join holdout on sc.id = holdout.id where holdout.survived is not null""")
def j1_j6_scores_join_labels(spark, sf_dir):
    sc = pseudo_scores(observations(spark, sf_dir)).select("id", "model", "prob")
    hl = holdout_labels(spark, sf_dir).where(F.col("survived").isNotNull())
    return sc.join(hl.select("id", "survived", "confidence"), "id", "inner")


HARD_SQL = [S.OBS, S.scores("obs", "sc"),
            "hard as (select id from sc where model = 'm1' and cast(prob >= 0.5 as integer) <> label)"]


@register("j2_semi_join_hard_cases", ops=["J2"], sql=W(*HARD_SQL) + """
select id, grp, flag, x2 from obs where id in (select id from hard)""")
def j2_semi_join_hard_cases(spark, sf_dir):
    obs = observations(spark, sf_dir)
    sc = pseudo_scores(obs)
    hard = sc.where((F.col("model") == "m1") & ((F.col("prob") >= 0.5).cast("int") != F.col("label"))).select("id")
    return obs.join(hard, "id", "left_semi").select("id", "grp", "flag", "x2")


@register("j3_anti_join_easy_positives", ops=["J3"], sql=W(*HARD_SQL) + """
select id, grp, flag, x2 from obs where label = 1 and id not in (select id from hard)""")
def j3_anti_join_easy_positives(spark, sf_dir):
    obs = observations(spark, sf_dir)
    sc = pseudo_scores(obs)
    hard = sc.where((F.col("model") == "m1") & ((F.col("prob") >= 0.5).cast("int") != F.col("label"))).select("id")
    return obs.where(F.col("label") == 1).join(hard, "id", "left_anti").select("id", "grp", "flag", "x2")


@register("j4_first_match_left_join", ops=["J4"], sql=W(
    S.OBS, S.REGISTRY,
    "f as (select grp, flag, c1, c2, cat, arg_min(label, ext_row) as label_ext, arg_min(name, ext_row) as name_ext, arg_min(ticket, ext_row) as ticket_ext from reg group by grp, flag, c1, c2, cat)",
) + """select obs.id, f.label_ext, f.name_ext, f.ticket_ext from obs left join f
  on obs.grp = f.grp and obs.flag = f.flag and obs.c1 = f.c1 and obs.c2 = f.c2 and obs.cat is not distinct from f.cat
where obs.side = 'test'""")
def j4_first_match_left_join(spark, sf_dir):
    te = observations(spark, sf_dir).where(F.col("side") == "test")
    out = J.left_join_first(te, registry(spark, sf_dir), KEYS5, "ext_row", ["label", "name", "ticket"])
    return out.select("id", "label_ext", "name_ext", "ticket_ext")


ENRICH_SQL = [
    S.OBS, S.REGISTRY,
    "tk as (select ticket, count(*) as tgs from reg group by ticket)",
    f"""r as (select grp, flag, c1, c2, coalesce(cast(floor(x2 * 10 + 0.5) as bigint), -1) as fk, ext_row,
  coalesce(nullif(regexp_extract(name, '{TITLE_RE}', 1), ''), 'Unknown') as title,
  coalesce(substr(cabin, 1, 1), 'Unknown') as deck, coalesce(tgs, 1) as tgs, ticket from reg left join tk using (ticket))""",
    "f as (select grp, flag, c1, c2, fk, arg_min(title, ext_row) as title, arg_min(deck, ext_row) as deck, arg_min(tgs, ext_row) as tgs, arg_min(ticket, ext_row) as ticket from r group by grp, flag, c1, c2, fk)",
    """e as (select obs.id, coalesce(f.title, 'Unknown') as title, coalesce(f.deck, 'Unknown') as deck,
  cast(coalesce(f.tgs, 1) as bigint) as ticket_group_size, case when f.title is null then 0 else 1 end as matched, f.ticket
  from obs left join f on obs.grp = f.grp and obs.flag = f.flag and obs.c1 = f.c1 and obs.c2 = f.c2
   and coalesce(cast(floor(obs.x2 * 10 + 0.5) as bigint), -1) = f.fk)""",
]


@register("j5_p16_enrichment_flags", ops=["J5", "P16", "P17", "P18", "S5"], sql=W(*ENRICH_SQL) + """
select id, matched, case title when 'Mr' then 0 when 'Mrs' then 1 when 'Miss' then 2 when 'Master' then 3
  when 'Dr' then 4 when 'Rev' then 5 when 'Unknown' then 6 else 6 end as title_enc,
  cast(title not in ('Mr', 'Mrs', 'Miss', 'Master') as integer) as rare_title,
  cast(title = 'Master' as integer) as is_master, cast(deck <> 'Unknown' as integer) as has_cabin,
  cast(deck in ('A', 'B', 'C') as integer) as upper_deck, cast(ticket_group_size > 1 as integer) as in_group,
  cast(ticket_group_size >= 4 as integer) as large_group from e""")
def j5_p16_enrichment_flags(spark, sf_dir):
    obs = observations(spark, sf_dir).select("id", *ENRICH_KEYS, "x2")
    e = J.enrich(obs, registry(spark, sf_dir), ENRICH_KEYS, "x2")
    return J.registry_flags(e).select("id", "matched", "title_enc", "rare_title", "is_master", "has_cabin",
                                      "upper_deck", "in_group", "large_group")


@register("j5_match_report", ops=["J5"], sql=W(*ENRICH_SQL) + """
select matched, title, deck, count(*) as n from e group by matched, title, deck""")
def j5_match_report(spark, sf_dir):
    obs = observations(spark, sf_dir).select("id", *ENRICH_KEYS, "x2")
    e = J.enrich(obs, registry(spark, sf_dir), ENRICH_KEYS, "x2")
    return e.groupBy("matched", "title", "deck").agg(F.count(F.lit(1)).alias("n"))
