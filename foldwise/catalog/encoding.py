"""Registered queries: target encoders (T1e-T5e)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.common import K, applied, split
from foldwise.catalog.registry import register
from foldwise.operators import encode as T
from foldwise.operators.foldstats import EVAL
from foldwise.operators.metrics import auc

W = S.with_
SPECS = {"grp_flag": ["grp", "flag"], "cat_flag": ["cat", "flag"], "grp_cat": ["grp", "cat"]}
M = 10.0
M_GRID = (5.0, 10.0, 20.0, 50.0)


def _on(a: str, b: str, keys) -> str:
    return " and ".join(f"{a}.{k} is not distinct from {b}.{k}" for k in keys)


def _loo_sql() -> str:
    ctes = [S.OBS, "tr as (select * from obs where side = 'train')", "g as (select avg(label) as g from tr)"]
    cols, joins = [], []
    for i, (name, keys) in enumerate(SPECS.items()):
        k = ", ".join(keys)
        ctes.append(f"s{i} as (select {k}, sum(label) as s, count(*) as n from tr group by {k})")
        joins.append(f"join s{i} on {_on('tr', f's{i}', keys)}")
        cols.append(f"(s{i}.s - label + {M} * g.g) / (s{i}.n - 1 + {M}) as te_{name}")
    return W(*ctes) + "select id, " + ", ".join(cols) + " from tr cross join g " + " ".join(joins)


@register("t1e_loo_target_encoding", ops=["T1e", "T3e"],
          doubles=[f"te_{n}" for n in SPECS], sql=_loo_sql())
def t1e_loo_target_encoding(spark, sf_dir):
    _, tr, _ = split(spark, sf_dir)
    rows = tr.withColumn(EVAL, F.lit(-1)).select("id", EVAL, "label", "grp", "flag", "cat")
    for name, keys in SPECS.items():
        st, g = T.fit_target_stats(tr, keys, "label")
        rows = T.loo_encode(rows, st, g, keys, "label", M, f"te_{name}")
    return rows.select("id", *[f"te_{n}" for n in SPECS])


def _full_sql() -> str:
    ctes = [S.OBS, "tr as (select * from obs where side = 'train')", "g as (select avg(label) as g from tr)"]
    cols, joins = [], []
    for i, (name, keys) in enumerate(SPECS.items()):
        k = ", ".join(keys)
        ctes.append(f"s{i} as (select {k}, sum(label) as s, count(*) as n from tr group by {k})")
        joins.append(f"left join s{i} on {_on('obs', f's{i}', keys)}")
        cols.append(f"coalesce((s{i}.s + {M} * g.g) / (s{i}.n + {M}), g.g) as te_{name}")
    return W(*ctes) + "select id, side, " + ", ".join(cols) + " from obs cross join g " + " ".join(joins)


@register("t5e_full_train_encoding", ops=["T5e"], doubles=[f"te_{n}" for n in SPECS], sql=_full_sql())
def t5e_full_train_encoding(spark, sf_dir):
    """The m-estimate of the whole training side on training and test rows alike. On training rows it contains the
    row's own label (a leak), so it is an option by name only; fits here use T1e."""
    obs, tr, _ = split(spark, sf_dir)
    rows = obs.withColumn(EVAL, F.lit(-1)).select("id", "side", EVAL, "grp", "flag", "cat")
    for name, keys in SPECS.items():
        st, g = T.fit_target_stats(tr, keys, "label")
        rows = T.mestimate_encode(rows, st, g, keys, M, f"te_{name}")
    return rows.select("id", "side", *[f"te_{n}" for n in SPECS])


def _oof_ctes():
    ctes = [*S.obs_folds(), "g as (select eval_fold, avg(label) as g from fit group by eval_fold)"]
    for i, (name, keys) in enumerate(SPECS.items()):
        k = ", ".join(keys)
        ctes.append(f"s{i} as (select eval_fold, {k}, sum(label) as s, count(*) as n from fit group by eval_fold, {k})")
    return ctes


def _oof_sql() -> str:
    cols, joins = [], []
    for i, (name, keys) in enumerate(SPECS.items()):
        joins.append(f"left join s{i} on app.eval_fold = s{i}.eval_fold and {_on('app', f's{i}', keys)}")
        cols.append(f"coalesce((s{i}.s + {M} * g.g) / (s{i}.n + {M}), g.g) as te_{name}")
    return (W(*_oof_ctes()) + "select id, app.eval_fold, " + ", ".join(cols) +
            " from app join g on app.eval_fold = g.eval_fold " + " ".join(joins))


@register("t2e_mestimate_oof_encoding", ops=["T2e", "T3e"], doubles=[f"te_{n}" for n in SPECS],
          sql=_oof_sql())
def t2e_mestimate_oof_encoding(spark, sf_dir):
    tr, app = applied(spark, sf_dir)
    rows = app.select("id", EVAL, "grp", "flag", "cat")
    for name, keys in SPECS.items():
        st, g = T.fit_target_stats(tr, keys, "label", "fold", K)
        rows = T.mestimate_encode(rows, st, g, keys, M, f"te_{name}")
    return rows.select("id", EVAL, *[f"te_{n}" for n in SPECS])


def _sweep_sql() -> str:
    parts = []
    for i, (name, keys) in enumerate(SPECS.items()):
        parts.append(f"""select '{name}' as spec, mm.m, app.label,
  coalesce((s{i}.s + mm.m * g.g) / (s{i}.n + mm.m), g.g) as prob
from app join g on app.eval_fold = g.eval_fold
  left join s{i} on app.eval_fold = s{i}.eval_fold and {_on('app', f's{i}', keys)}
  cross join (values {', '.join(f'(cast({m} as double))' for m in M_GRID)}) mm(m)
where app.side = 'train'""")
    ctes = _oof_ctes() + ["enc as (" + "\nunion all\n".join(parts) + ")"]
    return W(*ctes) + "select * from " + S.auc_sql("enc", ["spec", "m"]) + " t"


@register("t4e_smoothing_sweep_auc", ops=["T4e", "X4"], doubles=["auc", "n_pos", "n_neg"],
          sql=_sweep_sql())
def t4e_smoothing_sweep_auc(spark, sf_dir):
    tr, _ = applied(spark, sf_dir)
    rows = tr.withColumn(EVAL, F.col("fold")).select("id", EVAL, "label", "grp", "flag", "cat")
    parts = []
    for name, keys in SPECS.items():
        st, g = T.fit_target_stats(tr, keys, "label", "fold", K)
        enc = T.mestimate_sweep(rows, st, g, keys, M_GRID, "prob")
        parts.append(enc.select(F.lit(name).alias("spec"), "m", "label", "prob"))
    allp = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return auc(allp, "label", "prob", ["spec", "m"])
