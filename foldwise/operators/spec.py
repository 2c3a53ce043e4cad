"""I11-I13 (+ P6, P7, P22): the leak-safe feature builder as a fit/transform pair.

``FeatureSpec(...).fit(train, fold_col, k)`` fits every statistic for every eval fold at once
(``foldstats``); ``FeatureModel.transform(rows)`` applies them to rows tagged with ``eval_fold``
(training rows: their own fold → out-of-fold features; test rows: -1 → full-train statistics).
Stages run in the reference order: missing flags (before imputation) → imputation + base features
→ bins → interactions → polynomial → group statistics → frequency → range position → domain flags
→ extra function → fixed output schema.

Statistics of later stages are fitted on *imputed* training values, and imputation depends on the
eval fold. Instead of materialising the imputed training table once per fold, the null rows of each
(fold, group) go in as one value, the eval fold's fill, with their count: into the count vectors of
the distinct values (quantiles) and as a block without spread into (n, mean, M2) — exact, in two
aggregations of the rows, with no copy of a value per fold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions import features as P
from foldwise.functions.columns import clip
from foldwise.operators.foldstats import EVAL, eval_folds, fan_out, vector_columns, vector_of
from foldwise.operators.impute import apply_imputer, fit_imputer
from foldwise.plans.joins import join_on_keys, max_broadcast_rows, persisted
from foldwise.plans.session import cut_lineage
from foldwise.plans.ordered import vector_quantiles


@dataclass(frozen=True)
class Roles:
    """Column roles of the observation table (the reference's names in comments)."""
    cls: str = "grp"        # pclass
    flag: str = "flag"      # sex (0/1)
    a: str = "x1"           # age
    b: str = "x2"           # fare
    cat: str = "cat"        # embarked
    n1: str = "c1"          # sibsp
    n2: str = "c2"          # parch


#: Levels of a category that may become columns; more are an error, never cut.
MAX_LEVELS = 1_000


@dataclass(frozen=True)
class FeatureSpec:
    roles: Roles = field(default_factory=Roles)
    levels: tuple | None = None         # one-hot vocabulary of the category; None: learned from the training rows
    classes: tuple = (1, 2, 3)          # class values of the flag × class indicators
    missing_flags: bool = True
    age_bins: str | None = "rule"       # "rule" | "quantile" | None
    fare_bins: str | None = "quantile"  # "quantile" | None
    interactions: bool = True
    polynomial: bool = False
    group_stats: bool = True
    freq_encoding: bool = False
    rank_features: bool = False
    domain_features: bool = True
    n_fare_qbins: int = 5
    n_age_qbins: int = 5
    extra_fn: Callable[[DataFrame], DataFrame] | None = None

    def with_(self, **kw) -> "FeatureSpec":
        return replace(self, **kw)

    def fit(self, train: DataFrame, fold_col: str | None = None, k: int | None = None) -> "FeatureModel":
        return FeatureModel.fit(self, train, fold_col, k)


# Named presets (flags exactly as the reference's three presets)
PRESETS = {
    "minimal": dict(missing_flags=True, age_bins=None, fare_bins=None, interactions=False, polynomial=False,
                    group_stats=False, freq_encoding=False, rank_features=False, domain_features=False),
    "recommended": dict(missing_flags=True, age_bins="rule", fare_bins="quantile", interactions=True,
                        polynomial=False, group_stats=True, freq_encoding=False, rank_features=False,
                        domain_features=True),
    "kitchen_sink": dict(missing_flags=True, age_bins="rule", fare_bins="quantile", interactions=True,
                         polynomial=True, group_stats=True, freq_encoding=True, rank_features=True,
                         domain_features=True),
}


def preset(name: str, **kw) -> FeatureSpec:
    return FeatureSpec(**{**PRESETS[name], **kw})


GROUP_SPECS_OF = lambda r: [[r.cls], [r.flag], [r.cls, r.flag]]


#: Statistics the later stages read off one stacked table: the arm's number (column, group spec) and the group.
_KEYS = ("_arm", "_gkey")


def _stacked(train: DataFrame, fold_col: str | None, cls: str, arms: Sequence[tuple[str, str, list]]) -> DataFrame:
    """(fold, class, _arm, _gkey, _val): each row once per arm (column, spec name, spec columns)."""
    fk = [fold_col] if fold_col else []
    rows = F.array(*[F.struct(F.lit(i).alias("_arm"), _group_key(sp).alias("_gkey"), F.col(c).cast("double").alias("_val"))
                     for i, (c, _, sp) in enumerate(arms)])
    return train.select(*fk, cls, F.explode(rows).alias("_s")).select(*fk, cls, "_s.*")


def _fit_arms(st: DataFrame, cls: str, fold_col: str | None, k: int | None, fill: DataFrame,
              qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(eval_fold, _arm, _gkey) → quantiles ``names``, n, mean, std, min, max of the *imputed* training
    values. ``fill``: (eval_fold, _arm, class, _fill). Two aggregations of the stacked rows: blocks
    per (fold, arm, class) with (n, mean, M2, min, max, nulls), and count vectors per distinct value; the
    nulls of a block count as one value, the fill of each eval fold."""
    fk = [fold_col] if fold_col else []
    v = F.col("_val")
    blocks = persisted(st.groupBy(*fk, *_KEYS, cls).agg(
        F.count(v).alias("_bn"), F.avg(v).alias("_bm"), (F.var_pop(v) * F.count(v)).alias("_b2"),
        F.min(v).alias("_lo"), F.max(v).alias("_hi"), (F.count(F.lit(1)) - F.count(v)).alias("_null")))
    trained = fan_out(blocks, fold_col, k)
    filled = join_on_keys(trained.where("_null > 0").select(EVAL, *_KEYS, cls, "_null"), fill, [EVAL, "_arm", cls], "inner")
    filled = persisted(filled.groupBy(EVAL, *_KEYS, "_fill").agg(F.sum("_null").alias("_null")))
    # moments: every block, and every fill as a block without spread
    every = trained.where("_bn > 0").select(EVAL, *_KEYS, "_bn", "_bm", "_b2", "_lo", "_hi").unionByName(filled.select(
        EVAL, *_KEYS, F.col("_null").alias("_bn"), F.col("_fill").alias("_bm"), F.lit(0.0).alias("_b2"),
        F.col("_fill").alias("_lo"), F.col("_fill").alias("_hi")))
    sums = every.groupBy(EVAL, *_KEYS).agg(F.collect_list(F.struct("_bm", "_bn", "_b2")).alias("_b"), F.sum("_bn").alias("n"),
                                           F.min("_lo").alias("min"), F.max("_hi").alias("max"))
    mean = F.aggregate("_b", F.lit(0.0), lambda s, b: s + b._bn * b._bm) / F.col("n")
    sums = sums.withColumn("_b", F.array_sort("_b")).withColumn("mean", mean)  # a block per (fold, class)
    m2 = F.aggregate("_b", F.lit(0.0), lambda s, b: s + b._b2 + b._bn * (b._bm - F.col("mean")) * (b._bm - F.col("mean")))
    mo = sums.withColumn("std", F.sqrt(F.try_divide(m2, F.col("n") - 1))).drop("_b")
    # order statistics: count vectors of the values present, and of the fills
    vec = vector_columns(k)
    present = st.where(v.isNotNull()).select(*_KEYS, "_val", *vector_of(fold_col, k))
    fills = filled.select(*_KEYS, F.col("_fill").alias("_val"), *[F.when(F.col(EVAL) == e, F.col("_null")).otherwise(0).cast("long").alias(c)
                                                                  for e, c in zip(eval_folds(k), vec)])
    counts = present.unionByName(fills).groupBy(*_KEYS, "_val").agg(*[F.sum(c).alias(c) for c in vec])
    med = vector_quantiles(counts, "_val", list(_KEYS), qs, names, vec, EVAL, eval_folds(k))
    return persisted(mo.join(med, [EVAL, *_KEYS], "left"))


class FeatureModel:
    """Fitted statistics for every eval fold; ``transform`` is a chain of checked joins."""

    def __init__(self, spec: FeatureSpec, tables: dict, columns: list[str]):
        self.spec, self.tables, self.columns = spec, tables, columns  # spec: with the levels learned

    @classmethod
    def fit(cls, spec: FeatureSpec, train: DataFrame, fold_col: str | None, k: int | None) -> "FeatureModel":
        r = spec.roles
        if spec.levels is None:  # the training side fixes the output schema; a level unseen there is all zeros
            spec = spec.with_(levels=tuple(P.learn_levels(train, r.cat, MAX_LEVELS)))
        t: dict = {}
        # Imputation statistics (group medians by class, global medians, category mode)
        g, glob = fit_imputer(train, r.cls, [r.a, r.b], [r.cat], fold_col, k)
        g, fold = cut_lineage(g), cut_lineage(glob)
        edges = {c: q for c, q, on in ((r.a, spec.n_age_qbins, spec.age_bins), (r.b, spec.n_fare_qbins, spec.fare_bins)) if on == "quantile"}
        arms = [(c, name, sp) for c in (r.b, r.a) for name, sp in [("", []), *[("_".join(sp), sp) for sp in GROUP_SPECS_OF(r)]]
                if spec.group_stats or (name == "" and c in edges) or (spec.rank_features and (c, name) == (r.b, r.cls))]
        if arms:
            qs = sorted({0.5, *[i / q for q in edges.values() for i in range(q + 1)]})
            names = [f"_q{i}" for i in range(len(qs))]
            stats = cut_lineage(_fit_arms(_stacked(train, fold_col, r.cls, arms), r.cls, fold_col, k,
                                          _fills(train, r, fold_col, k, g, fold, arms), qs, names))
            number = {(c, name): i for i, (c, name, _) in enumerate(arms)}
            of_fold = []  # one row per eval fold: the global mean, the quantile edges
            for c in (r.b, r.a):
                if (c, "") not in number:
                    continue
                here = F.col("_arm") == number[c, ""]
                of_fold.append(F.max(F.when(here, F.col("mean"))).alias(f"_gm_{c}"))
                if c in edges:
                    e = F.array_sort(F.array_distinct(F.array(*[F.col(names[qs.index(i / edges[c])]) for i in range(edges[c] + 1)])))
                    e = F.slice(e, 2, F.greatest(F.size(e) - 2, F.lit(0)))
                    of_fold.append(F.first(F.when(here, e), ignorenulls=True).alias(f"_edges_{c}"))
            if of_fold:
                fold = fold.join(stats.groupBy(EVAL).agg(*of_fold), EVAL, "left")
            for name in ["_".join(sp) for sp in GROUP_SPECS_OF(r)]:  # one row per (eval fold, group): both columns' statistics
                own = [c for c in (r.b, r.a) if (c, name) in number]
                wide = [F.max(F.when(F.col("_arm") == number[c, name], x)).alias(f"_{what}_{c}") for c in own
                        for what, x in (("med", F.col(names[qs.index(0.5)])), ("mean", F.col("mean")),
                                        ("sd", F.coalesce("std", F.lit(0.0))), ("lo", F.col("min")), ("hi", F.col("max")))]
                if spec.group_stats or (spec.rank_features and name == r.cls):
                    t[name] = stats.where(F.col("_arm").isin([number[c, name] for c in own])).groupBy(EVAL, "_gkey").agg(*wide)
        if spec.freq_encoding:
            vc = train.groupBy(*([fold_col] if fold_col else []), r.cls).agg(F.count(F.lit(1)).alias("_n"))
            vc = fan_out(vc, fold_col, k).groupBy(EVAL, r.cls).agg(F.sum("_n").alias("_n"))
            t["freq"] = vc.withColumn("_freq", F.col("_n") / F.sum("_n").over(Window.partitionBy(EVAL))).select(EVAL, r.cls, "_freq")
        # the size of every statistics table is checked here, once; their lineage is cut, so that a chain of
        # joins isn't planned over the whole history of each
        t = {"group_medians": g, "fold": cut_lineage(fold), **{name: cut_lineage(tbl) for name, tbl in t.items()}}
        limit = max_broadcast_rows(train)
        t["_small"] = {name: tbl.count() <= limit for name, tbl in t.items()}
        model = cls(spec, t, [])
        model.columns = model._columns()
        return model

    def _columns(self) -> list[str]:
        s, r = self.spec, self.spec.roles
        cols = [r.cls, r.flag, r.a, r.n1, r.n2, r.b, *[f"{r.cat}_{v}" for v in s.levels],
                "family_size", "is_alone", f"log_{r.b}", f"{r.b}_per_person", f"{r.cls}_{r.flag}"]
        if s.missing_flags:
            cols += [f"{c}_missing" for c in (r.a, r.b, r.cat)]
        if s.age_bins == "rule":
            cols.append(f"{r.a}_bin")
        elif s.age_bins == "quantile":
            cols.append(f"{r.a}_qbin")
        if s.fare_bins == "quantile":
            cols.append(f"{r.b}_qbin")
        if s.interactions:
            cols += [f"{r.a}_{r.cls}", f"{r.b}_{r.cls}", f"log_{r.b}_per_{r.cls}", f"family_{r.flag}", f"alone_{r.flag}"]
            for pc in s.classes:
                cols += [f"{r.flag}1_{pc}", f"{r.flag}0_{pc}"]
        if s.polynomial:
            cols += [f"{r.a}_sq", f"{r.b}_sq", f"{r.a}_{r.b}"]
        if s.group_stats:
            for c in (r.b, r.a):
                for sp in GROUP_SPECS_OF(r):
                    sfx = "_".join(sp)
                    cols += [f"{c}_diff_{sfx}", f"{c}_z_{sfx}"]
        if s.freq_encoding:
            cols.append(f"{r.cls}_freq")
        if s.rank_features:
            cols.append(f"{r.b}_pctile_in_{r.cls}")
        if s.domain_features:
            cols += ["is_child", "is_mother", f"{r.b}_zero", "family_small", "family_large", "child_with_family"]
        return cols

    def transform(self, rows: DataFrame, keep: Sequence[str] = ("id", EVAL)) -> DataFrame:
        s, r, t = self.spec, self.spec.roles, self.tables
        df = rows
        if s.missing_flags:  # P8: before imputation
            df = df.select("*", *P.missing_flags([r.a, r.b, r.cat]))
        def joined(df, name, keys):
            return join_on_keys(df, t[name], keys, "left") if not t["_small"][name] else df.join(F.broadcast(t[name]), keys, "left")

        df = apply_imputer(df, t["group_medians"], t["fold"], r.cls, [r.a, r.b], [r.cat], checked=not all(t["_small"][x] for x in ("group_medians", "fold")))
        df = df.select("*", *P.one_hot(r.cat, s.levels, r.cat),
                       *P.base_derived(r.n1, r.n2, r.b, r.cls, r.flag))
        if s.age_bins == "rule":
            df = df.withColumn(f"{r.a}_bin", P.rule_bin(r.a))
        elif s.age_bins == "quantile":
            df = df.withColumn(f"{r.a}_qbin", P.apply_edges(r.a, F.col(f"_edges_{r.a}")))
        if s.fare_bins == "quantile":
            df = df.withColumn(f"{r.b}_qbin", P.apply_edges(r.b, F.col(f"_edges_{r.b}")))
        if s.interactions:
            df = df.select("*", *P.interactions(r.a, r.b, r.cls, r.flag, s.classes, f"log_{r.b}", "family_size", "is_alone"))
        if s.polynomial:
            df = df.select("*", *P.polynomial(r.a, r.b))
        if s.group_stats or s.rank_features:
            for sp in GROUP_SPECS_OF(r):
                name = "_".join(sp)
                if name not in t:
                    continue
                df = joined(df.withColumn("_gkey", _group_key(sp)), name, [EVAL, "_gkey"])
                new = []
                for c in (r.b, r.a) if s.group_stats else ():
                    med = F.coalesce(f"_med_{c}", f"_gm_{c}")
                    mean = F.coalesce(f"_mean_{c}", f"_gm_{c}")
                    sd = F.coalesce(F.col(f"_sd_{c}"), F.lit(1.0))
                    sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
                    new += [(F.col(c) - med).alias(f"{c}_diff_{name}"), ((F.col(c) - mean) / sd).alias(f"{c}_z_{name}")]
                if s.rank_features and name == r.cls:
                    lo, hi = F.coalesce(f"_lo_{r.b}", F.lit(0.0)), F.coalesce(f"_hi_{r.b}", F.lit(1.0))
                    width = F.when(hi != lo, hi - lo).otherwise(F.lit(1.0))
                    new.append(clip((F.col(r.b) - lo) / width, 0.0, 1.0).alias(f"{r.b}_pctile_in_{r.cls}"))
                df = df.select(*[c for c in df.columns if c != "_gkey" and c not in t[name].columns or c == EVAL], *new)
        if s.freq_encoding:
            df = joined(df, "freq", [EVAL, r.cls]).withColumn(f"{r.cls}_freq", F.coalesce("_freq", F.lit(0.0))).drop("_freq")
        if s.domain_features:
            df = df.select("*", *P.domain_flags(r.a, r.flag, r.n2, r.b, "family_size"))
        if s.extra_fn is not None:
            df = s.extra_fn(df)
            extra = [c for c in df.columns if c not in set(self.columns) and c not in rows.columns]
        else:
            extra = []
        return P.select_or_zero(df, [*keep, *self.columns, *extra])  # P22: fixed schema


def _group_key(cols) -> "F.Column":
    """One string key per group spec (null-proof, position-preserving)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u2205")) for c in cols])


def _fills(train: DataFrame, r: Roles, fold_col: str | None, k: int | None, g: DataFrame, glob: DataFrame,
           arms: Sequence[tuple[str, str, list]]) -> DataFrame:
    """(eval_fold, _arm, class, _fill): what imputation puts in; a class without any value gets the global median."""
    classes = fan_out(train.select(*([fold_col] if fold_col else []), r.cls).distinct(), fold_col, k).select(EVAL, r.cls).distinct()
    both = join_on_keys(classes, glob, [EVAL], "inner", checked=False).join(g, [EVAL, r.cls], "left")
    rows = F.array(*[F.struct(F.lit(i).alias("_arm"), F.coalesce(f"{c}_median", f"{c}_median_global").cast("double").alias("_fill"))
                     for i, (c, _, _) in enumerate(arms)])
    return persisted(both.select(EVAL, r.cls, F.explode(rows).alias("_s")).select(EVAL, r.cls, "_s.*"))
