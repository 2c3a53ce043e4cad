"""DuckDB oracle text shared by the registered queries: the adapter view and hash uniforms.

Each oracle is plain SQL over the pre-registered parquet views; these helpers only build the common
CTEs so every oracle states the same adapter as ``foldwise.sources.tables``.
"""

from __future__ import annotations


def u(seed, key: str) -> str:
    """DuckDB twin of ``foldwise.functions.columns.hash_uniform``."""
    return f"(cast(('0x'||substr(md5(concat('{seed}|',cast({key} as varchar))),1,13)) as bigint)/4503599627370496.0)"


def h24(seed, key: str) -> str:
    return f"cast(('0x'||substr(md5(concat('{seed}|',cast({key} as varchar))),1,6)) as bigint)"


OBS = f"""obs as (
  select o_orderkey as id,
    case when o_orderstatus = 'F' then 1 else 0 end as label,
    cast(n_regionkey + 1 as integer) as grp,
    case when o_orderpriority <= '2-HIGH' then 1 else 0 end as flag,
    case when {u('cat', 'o_orderkey')} >= 0.02 then c_mktsegment end as cat,
    case when {u('x1', 'o_orderkey')} >= 0.2 then c_acctbal / 100.0 end as x1,
    o_totalprice / 1000.0 as x2,
    cast(o_custkey % 4 as integer) as c1,
    cast(o_custkey % 3 as integer) as c2,
    case when {u('side', 'o_orderkey')} < 0.5 then 'train' else 'test' end as side
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
)"""


def folds(src: str = "obs", k: int = 5, seed: int = 42, name: str = "obsf") -> str:
    return f"""{name} as (
  select *, cast((row_number() over (partition by label order by {u(seed, 'id')}, id) - 1) % {k} as integer) as fold
  from {src}
)"""


def pseudo_prob(k: int) -> str:
    return f"(least(({h24(f'm{k}', 'id')} // 167773) + {8 * k} * label, 99) / 100.0)"


def scores(src: str = "obs", name: str = "scores") -> str:
    parts = [f"select id, label, side, 'm{k}' as model, {pseudo_prob(k)} as prob from {src}"
             for k in range(1, 6)]
    return f"{name} as (\n  " + "\n  union all ".join(parts) + "\n)"


def auc_sql(src: str, group: list[str], score: str = "prob", label: str = "label") -> str:
    """Tie-aware AUC per group: Mann-Whitney over distinct scores."""
    g = ", ".join(group)
    gp = (g + ", ") if group else ""
    part = f"partition by {g} " if group else ""
    return f"""(select {gp}sum(p * (coalesce(nb, 0) + 0.5 * n)) / nullif(sum(p) * sum(n), 0) as auc,
          sum(p) as n_pos, sum(n) as n_neg
   from (select *, sum(n) over ({part}order by {score} rows between unbounded preceding and 1 preceding) as nb
         from (select {gp}{score}, cast(sum(case when {label} = 1 then 1 else 0 end) as double) as p,
                      cast(sum(case when {label} = 0 then 1 else 0 end) as double) as n
               from {src} group by {gp}{score}) d) c
   {('group by ' + g) if group else ''})"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


EVAL_FOLDS = "ev as (select * from (values (-1), (0), (1), (2), (3), (4)) v(eval_fold))"


def obs_folds() -> list[str]:
    """CTEs: obs, trf (train rows with fold), obsf (all rows, fold null on test), fit (train rows
    fanned out to every eval fold they train, -1 = all), app (all rows with their eval fold)."""
    return [
        OBS,
        "tr as (select * from obs where side = 'train')",
        folds("tr", name="trf"),
        "obsf as (select * from trf union all by name select *, cast(null as integer) as fold from obs where side = 'test')",
        EVAL_FOLDS,
        "fit as (select ev.eval_fold, trf.* from trf join ev on trf.fold <> ev.eval_fold)",
        "app as (select *, coalesce(fold, -1) as eval_fold from obsf)",
    ]


def mode_sql(src: str, value: str, keys: list[str], out: str) -> str:
    k = ", ".join(keys)
    return f"""(select {k}, {value} as {out} from (
      select {k}, {value}, row_number() over (partition by {k} order by count(*) desc, {value}) as rn
      from {src} where {value} is not null group by {k}, {value}) m where rn = 1)"""


REGISTRY = f"""reg as (
  select o_orderkey as ext_row, obs.label, obs.grp, obs.flag, obs.c1, obs.c2, obs.cat, obs.x1,
    case when {u('rfare', 'o_orderkey')} >= 0.03 then obs.x2 end as x2,
    case when {u('notitle', 'o_orderkey')} < 0.05 then c_name
         else c_name || ', ' || (['Mr', 'Mrs', 'Miss', 'Master', 'Dr', 'Rev', 'Col'])[cast(floor({u('title', 'o_orderkey')} * 7) as integer) + 1] || '. Holder' end as name,
    cast(o_custkey as varchar) as ticket,
    case when {u('cabin', 'o_orderkey')} >= 0.7 then substr(c_mktsegment, 1, 1) || cast(o_custkey % 100 as varchar) end as cabin
  from obs join orders on obs.id = o_orderkey join customer on o_custkey = c_custkey
)"""


def seeded_prob(k: int, s: int) -> str:
    return f"(least(({h24(f'm{k}s{s}', 'id')} // 167773) + {8 * k} * label, 99) / 100.0)"


def seeded_scores(src: str = "obs", name: str = "ss", seeds=(0, 1, 2)) -> str:
    parts = [f"select id, label, side, {s} as seed, 'm{k}' as model, {seeded_prob(k, s)} as prob from {src}"
             for s in seeds for k in range(1, 6)]
    return f"{name} as (\n  " + "\n  union all ".join(parts) + "\n)"


def wide_sql(src: str, keys: str, models=("m1", "m2", "m3", "m4", "m5"), name: str = "wd") -> str:
    cols = ", ".join(f"max(case when model = '{m}' then prob end) as {m}" for m in models)
    return f"{name} as (select {keys}, {cols} from {src} group by {keys})"


def grid_values(grid) -> str:
    rows = ", ".join("(" + ", ".join([str(i)] + [f"cast({w!r} as double)" for w in ws]) + ")"
                     for i, ws in enumerate(grid))
    names = ", ".join(["grid_id"] + [f"w{i}" for i in range(len(grid[0]))])
    return f"(values {rows}) g({names})"
