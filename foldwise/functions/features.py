"""Scalar feature builders. Pure ``Column`` expressions (stay inside whole-stage codegen);
every function takes column names as parameters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import as_int, col

# fixed values: rule age bins (right-closed, lowest edge included), fallback bin for null / out of range
RULE_AGE_EDGES = (0, 12, 18, 35, 60, 100)
RULE_BIN_FALLBACK = 2


def map_values(c, mapping: Mapping) -> Column:
    """Dictionary lookup; values outside the mapping become null (pandas ``Series.map``)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[col(c)]


def one_hot(c, values: Iterable, prefix: str | None = None) -> list[Column]:
    """One 0/1 column per learned value; null (or unseen) → all zeros."""
    name = prefix or (c if isinstance(c, str) else "v")
    return [F.coalesce((col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{name}_{v}") for v in values]


def learn_levels(df: DataFrame, c: str, max_levels: int = 10_000) -> list:
    """Sorted distinct non-null values of a category (the one-hot vocabulary fixes the output schema,
    so it must reach the driver; an over-wide vocabulary is an error, never silently cut)."""
    levels = [r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct()
              .orderBy(c).limit(max_levels + 1).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{c}: more than {max_levels} levels; one-hot encoding is not meaningful")
    return levels


def dummies(df: DataFrame, cols: Sequence[str] | None = None, drop_source: bool = True,
            levels: Mapping[str, list] | None = None) -> DataFrame:
    """``get_dummies`` over every string column (or ``cols``)."""
    cols = list(cols) if cols is not None else [f.name for f in df.schema.fields
                                                 if f.dataType.typeName() == "string"]
    out = df
    for c in cols:
        lv = (levels or {}).get(c) or learn_levels(df, c)
        out = out.select("*", *one_hot(c, lv, c))
    return out.drop(*cols) if drop_source else out


def family_size(a="sibsp", b="parch") -> Column:
    """P4."""
    return col(a) + col(b) + F.lit(1)


def base_derived(a="sibsp", b="parch", value="fare", cls="pclass", flag="sex") -> list[Column]:
    """P4 + P5: family size, alone flag, log1p, per-person value, class×10 + flag."""
    fam = family_size(a, b)
    return [
        fam.alias("family_size"),
        (fam == 1).cast("int").alias("is_alone"),
        F.log1p(col(value)).alias(f"log_{value}"),
        F.try_divide(col(value), fam).alias(f"{value}_per_person"),
        (col(cls) * 10 + col(flag)).alias(f"{cls}_{flag}"),
    ]


def missing_flags(cols: Sequence[str]) -> list[Column]:
    """Null indicators — must be taken before any imputation in the plan."""
    return [col(c).isNull().cast("int").alias(f"{c}_missing") for c in cols]


def rule_bin(c, edges: Sequence[float] = RULE_AGE_EDGES, fallback: int = RULE_BIN_FALLBACK) -> Column:
    """Right-closed bins with the lowest edge included; null / out of range → ``fallback``."""
    x = col(c)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) & (x <= hi) if i == 0 else (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(fallback))


def apply_edges(c, edges_col: Column) -> Column:
    """Bin index for interior edges (ends are ±inf): count of edges strictly below the value;
    null → -1. ``edges_col`` is an array column of interior edges."""
    x = col(c)
    return F.when(x.isNull(), F.lit(-1)).otherwise(F.size(F.filter(edges_col, lambda e: e < x)))


def interactions(age="age", fare="fare", cls="pclass", flag="sex", classes=(1, 2, 3),
                 log_fare: str | None = "log_fare", fam: str | None = "family_size",
                 alone: str | None = "is_alone") -> list[Column]:
    """Products and flag × class indicators."""
    out = [(col(age) * col(cls)).alias(f"{age}_{cls}"), (col(fare) * col(cls)).alias(f"{fare}_{cls}")]
    if log_fare:
        out.append(F.try_divide(col(log_fare), col(cls)).alias(f"{log_fare}_per_{cls}"))
    if fam:
        out.append((col(fam) * col(flag)).alias(f"family_{flag}"))
    if alone:
        out.append((col(alone) * col(flag)).alias(f"alone_{flag}"))
    for pc in classes:
        out.append(as_int((col(flag) == 1) & (col(cls) == pc)).alias(f"{flag}1_{pc}"))
        out.append(as_int((col(flag) == 0) & (col(cls) == pc)).alias(f"{flag}0_{pc}"))
    return out


def polynomial(a="age", b="fare") -> list[Column]:
    """P13."""
    return [(col(a) ** 2).alias(f"{a}_sq"), (col(b) ** 2).alias(f"{b}_sq"),
            (col(a) * col(b)).alias(f"{a}_{b}")]


def domain_flags(age="age", flag="sex", parch="parch", fare="fare", fam="family_size") -> list[Column]:
    """Child (≤12), mother, zero value, family 2..4, family ≥5, child with family."""
    child = col(age) <= 12
    return [
        as_int(child).alias("is_child"),
        as_int((col(flag) == 1) & (col(parch) > 0) & (col(age) > 18)).alias("is_mother"),
        as_int(col(fare) == 0).alias(f"{fare}_zero"),
        as_int(col(fam).between(2, 4)).alias("family_small"),
        as_int(col(fam) >= 5).alias("family_large"),
        as_int(child & (col(fam) > 1)).alias("child_with_family"),
    ]


def exception_flags(age="age", flag="sex", cls="pclass", a="sibsp", b="parch") -> list[Column]:
    """flag==0 ("male") exception indicators and age × flag products."""
    fam = family_size(a, b)
    male = (col(flag) == 0).cast("int")
    is_m = col(flag) == 0
    return [
        as_int(is_m & (fam > 1)).alias("male_with_family"),
        as_int(is_m & (col(age) < 15)).alias("young_male"),
        as_int(is_m & (col(cls) <= 2)).alias("male_upper_class"),
        as_int(is_m & (col(b) > 0)).alias("male_with_children"),
        as_int(col(age) >= 60).alias("is_elderly"),
        as_int((col(cls) == 3) & (fam >= 2) & (fam <= 4)).alias("small_family_3rd"),
        (col(age) * male).alias("age_x_male"),
        (col(age) * (F.lit(1) - male)).alias("age_x_female"),
    ]


# fixed value: honorific pattern — ", Word." with Unicode word characters (Python's ``\w``)
TITLE_PATTERN = r", ([\p{L}\p{N}_]+)\."


def title_of(name_col, pattern: str = TITLE_PATTERN) -> Column:
    """First capture of the pattern; no match → null (``regexp_extract`` gives '')."""
    return F.nullif(F.regexp_extract(col(name_col), pattern, 1), F.lit(""))


def first_letter(c) -> Column:
    """deck = first character; null stays null."""
    return F.substring(col(c), 1, 1)


def threshold(prob="prob", t: float = 0.5) -> Column:
    """P20."""
    return (col(prob) >= F.lit(t)).cast("int")


def confidence_filter(conf_col, level: str | None) -> Column:
    """``None``/'all' → everything; 'sure' → unique or all_agree; 'unique' → unique only."""
    c = col(conf_col)
    if level in (None, "all"):
        return F.lit(True)
    if level == "sure":
        return c.isin("unique", "all_agree")
    if level == "unique":
        return c == "unique"
    raise ValueError(level)


def select_or_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fixed output schema — missing columns become 0."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(0).alias(c) for c in cols])


def feature_subset(available: Sequence[str], names: Sequence[str] | None) -> list[str]:
    """A named subset intersected with the available columns (None → all)."""
    if names is None:
        return list(available)
    keep = set(names)
    return [c for c in available if c in keep]
