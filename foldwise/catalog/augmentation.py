"""Registered queries: pseudo labels and mixup augmentation (A1-A5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.common import K, SEED
from foldwise.catalog.modeling import CATS, GRPS, _lr, _split
from foldwise.catalog.registry import register
from foldwise.operators import augment as A
from foldwise.operators import cv as CV
from foldwise.operators.fits import Group, fit_groups, score_all, union_all
from foldwise.operators.metrics import auc
from foldwise.operators.spec import preset
from foldwise.plans.joins import packed, persisted
from foldwise.plans.session import cut_lineage
from foldwise.sources.tables import observations, pseudo_scores

W = S.with_
THRESHOLDS = (0.6, 0.75, 0.9, 0.95, 0.99)
MIX_COLS = ["x2", "c1", "c2"]


@register("a1_agreement_pseudo_labels", ops=["A1"], doubles=["p_mean"], sql=W(S.OBS, S.scores("obs", "sc"),
    "ag as (select id, min(prob) as p_min, max(prob) as p_max, avg(prob) as p_mean from sc where side = 'test' group by id)") +
    "select t.threshold, id, cast(p_mean > 0.5 as integer) as pseudo_label, p_mean from ag cross join (values " +
    ", ".join(f"(cast({t!r} as double))" for t in THRESHOLDS) + ") t(threshold) where p_min > t.threshold or p_max < 1.0 - t.threshold")
def a1_agreement_pseudo_labels(spark, sf_dir):
    sc = pseudo_scores(observations(spark, sf_dir)).where(F.col("side") == "test")
    return A.pseudo_labels(sc, THRESHOLDS)


def _u_sql(text: str) -> str:
    return f"(cast(('0x'||substr(md5({text}),1,13)) as bigint)/4503599627370496.0)"


def _mix_sql(n_aug: int = 100, alpha: float = 0.2, seed: int = 42) -> str:
    key = f"'{seed}', cast(label as varchar), cast(draw as varchar)"
    ex = 1.0 / alpha
    tries = (f"list_filter(list_transform(range(0, {A.JOHNK_TRIES}), lambda t: {{'x': pow({_u_sql(f'concat_ws(chr(124), {key}, cast(t as varchar), ' + chr(39) + 'u' + chr(39) + ')')}, {ex!r}), "
             f"'y': pow({_u_sql(f'concat_ws(chr(124), {key}, cast(t as varchar), ' + chr(39) + 'v' + chr(39) + ')')}, {ex!r})}}), lambda s: s.x + s.y <= 1.0 and s.x + s.y > 0.0)")
    return W(
        S.OBS, "tr as (select * from obs where side = 'train')",
        f"pos as (select label, x2, c1, c2, row_number() over (partition by label order by {S.u('mix' + str(seed), 'id')}, id) - 1 as pos from tr)",
        "sz as (select label, count(*) as n_class from tr group by label having count(*) >= 2)",
        f"dr as (select label, n_class, unnest(range(0, {n_aug})) as draw from sz)",
        f"""dd as (select label, draw, cast(floor({_u_sql(f"concat_ws('|', {key}, 'i')")} * n_class) as bigint) as pi,
  cast(floor({_u_sql(f"concat_ws('|', {key}, 'j')")} * (n_class - 1)) as bigint) as j0, {tries} as ok from dr)""",
        "d2 as (select label, draw, pi, case when j0 >= pi then j0 + 1 else j0 end as pj, case when len(ok) > 0 then ok[1].x / (ok[1].x + ok[1].y) else 0.5 end as lam from dd)",
    ) + """select d2.label, d2.draw, d2.lam, d2.lam * a.x2 + (1.0 - d2.lam) * b.x2 as x2, d2.lam * a.c1 + (1.0 - d2.lam) * b.c1 as c1,
  d2.lam * a.c2 + (1.0 - d2.lam) * b.c2 as c2
from d2 join pos a on a.label = d2.label and a.pos = d2.pi join pos b on b.label = d2.label and b.pos = d2.pj"""


@register("a3_within_class_mixup", ops=["A3"], doubles=["lam", "x2", "c1", "c2"], sql=_mix_sql())
def a3_within_class_mixup(spark, sf_dir):
    tr = observations(spark, sf_dir).where(F.col("side") == "train")
    return A.mixup(tr, MIX_COLS, "label", "id", n_aug=100, alpha=0.2, seed=42)


def _a4_sql() -> str:
    mix = _mix_sql()
    head, body = mix.split("\nselect d2.label, d2.draw", 1)
    aug = "aug as (select d2.label, d2.draw" + body + ")"
    parts = []
    for c in MIX_COLS:
        parts.append(f"""select '{c}' as "column", o.m as mean_orig, o.s as std_orig, a.m as mean_aug, a.s as std_aug,
  a.m - o.m as mean_diff, a.s - o.s as std_diff
from (select avg({c}) as m, stddev_samp({c}) as s from tr) o, (select avg({c}) as m, stddev_samp({c}) as s from aug) a""")
    return head + ",\n" + aug + "\n" + "\nunion all\n".join(parts)


@register("a4_augmentation_summary", ops=["A4", "A3"],
          doubles=["mean_orig", "std_orig", "mean_aug", "std_aug", "mean_diff", "std_diff"], sql=_a4_sql())
def a4_augmentation_summary(spark, sf_dir):
    tr = observations(spark, sf_dir).where(F.col("side") == "train")
    aug = A.mixup(tr, MIX_COLS, "label", "id", n_aug=100, alpha=0.2, seed=42)
    return A.augmentation_summary(tr, aug, MIX_COLS)


@register("a2_pseudo_label_augmented_cv", ops=["A2", "A1", "J8"])
def a2_pseudo_label_augmented_cv(spark, sf_dir):
    """Training folds get the agreement-gated pseudo-labelled test rows (fold = -2: they train every
    eval fold and are never validated); features are fitted per fold on the union."""
    tr, te = _split(spark, sf_dir)
    sc = pseudo_scores(te.drop("label").withColumn("label", F.lit(0)))
    pl = A.pseudo_labels(sc, [0.6]).select("id", F.col("pseudo_label").alias("label"))
    pseudo = te.drop("label").join(pl, "id").withColumn("fold", F.lit(-2))
    both = persisted(tr.unionByName(pseudo.select(*tr.columns)))
    fm = preset("minimal", levels=CATS, classes=GRPS).fit(both, "fold", K)
    scores, metrics = CV.cross_validate_oof(both, {"logreg_pseudo": _lr(1.0)}, fm, K)
    return metrics.select("model", "fold", "auc", "n")


@register("a5_mixup_sweep_cv", ops=["A5", "A3", "J8"])
def a5_mixup_sweep_cv(spark, sf_dir):
    """CV AUC for a small (n_aug × α) sweep: mixup rows (from the training folds' rows) join every
    training fold; the validation folds stay original rows."""
    tr, _ = _split(spark, sf_dir)
    fm = preset("minimal", levels=CATS, classes=GRPS).fit(tr, "fold", K)
    fit_rows, val_rows = CV.cv_matrices(tr, fm, K)
    cols = ["x2", "c1", "c2", "grp", "flag"]
    pos = persisted(A.class_positions(fit_rows, cols, "label", "id", SEED, ["eval_fold"]))
    # mixup rows of every fold: (eval fold, class) groups; a few rows each, kept for all fits that read them
    extra = {(n_aug, alpha): cut_lineage(A.mixup(fit_rows, cols, "label", "id", n_aug, alpha, SEED, ["eval_fold"], pos)
                                         .select("eval_fold", "label", *cols).coalesce(1)) for n_aug in (50, 100) for alpha in (0.2, 0.4)}
    pos.unpersist()
    sizes, more = CV.fold_sizes(fit_rows), {key: CV.fold_sizes(x) for key, x in extra.items()}
    configs, parts = [(0, 0.0), *extra], []
    for f in range(K):
        n = sizes.get(f, 0)
        own = persisted(packed(fit_rows.where(F.col("eval_fold") == f).select("label", *cols), n, bagged=False))
        groups = []
        for key in configs:
            n_key = n + more[key].get(f, 0) if key in extra else n
            fr = own.unionByName(extra[key].where(F.col("eval_fold") == f).drop("eval_fold")) if key in extra else own
            groups.append(Group(fr, n_key, [(cols, _lr(1.0)(len(cols), n_key))]))
        models = [(str(i), cols, m) for i, (m,) in enumerate(fit_groups(groups))]
        own.unpersist()
        parts.append(score_all(val_rows.where(F.col("eval_fold") == f), models, ["label"]))
    key = F.array(*[F.struct(F.lit(n_aug).alias("n_aug"), F.lit(alpha).alias("alpha")) for n_aug, alpha in configs])[F.col("model").cast("int")]
    return auc(union_all(parts), "label", "prob", ["model"]).select(key["n_aug"].alias("n_aug"), key["alpha"].alias("alpha"), "auc")
