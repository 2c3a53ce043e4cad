"""Table profiling and two-table comparison. Each plot of the reference is re-aimed as the
table behind it. Column-wise statistics are computed in one aggregation and stacked to long form."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators.foldstats import fold_quantiles_multi
from foldwise.plans.joins import dim_join, join_on_keys


def _stack(values: list[tuple[str, list[Column]]], names: list[str]) -> Column:
    """Array of structs (one per column) to explode into a long table."""
    return F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[v.alias(n) for v, n in zip(vals, names)])
        for c, vals in values]))


def table_info(df: DataFrame) -> DataFrame:
    """Dtype and non-null count per column (one aggregation)."""
    aggs = [F.count(F.col(f"`{c}`")).alias(f"nn_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    rows = [(c, [F.lit(df.schema[c].dataType.simpleString()), F.col(f"nn_{i}")])
            for i, c in enumerate(df.columns)]
    return one.select("_rows", _stack(rows, ["dtype", "non_null"]).alias("s")).select(
        "s.column", "s.dtype", F.col("s.non_null").cast("long").alias("non_null"),
        F.col("_rows").cast("long").alias("rows"))


def missing_table(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing count and percent per column (only columns with any missing value)."""
    info = table_info(df)
    out = info.select("column", (F.col("rows") - F.col("non_null")).alias("missing"),
                      ((F.col("rows") - F.col("non_null")) * 100.0 / F.col("rows")).alias("missing_pct"))
    return out.where(F.col("missing") > 0) if only_missing else out


def missing_compare(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing percent in two tables and the difference in points."""
    ma = missing_table(a.select(*cols), False).select("column", F.col("missing_pct").alias("pct_a"))
    mb = missing_table(b.select(*cols), False).select("column", F.col("missing_pct").alias("pct_b"))
    return ma.join(mb, "column").withColumn("delta_pts", F.col("pct_b") - F.col("pct_a"))


def duplicate_rows(df: DataFrame, exclude: Sequence[str] = ("id",)) -> DataFrame:
    """Rows that repeat an earlier row on every column except ``exclude`` (nulls equal)."""
    cols = [c for c in df.columns if c not in set(exclude)]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"),
                 F.count(F.lit(1)).alias("distinct_rows"))


def describe_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count mean std min q25 q50 q75 max per column (exact quantiles, not ``summary``)."""
    by = list(by)
    qs = [0.25, 0.5, 0.75]
    q = fold_quantiles_multi(df, cols, by, qs, None, None).drop("eval_fold")
    stacked = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                          F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    m = stacked.groupBy(*by, "s.column").agg(
        F.count("s.v").alias("count"), F.avg("s.v").alias("mean"), F.stddev_samp("s.v").alias("std"),
        F.min("s.v").alias("min"), F.max("s.v").alias("max"))
    qlong = q.select(*by, _stack([(c, [F.col(f"{c}_q25"), F.col(f"{c}_q50"), F.col(f"{c}_q75")]) for c in cols],
                                 ["q25", "q50", "q75"]).alias("s")).select(*by, "s.*")
    return m.join(qlong, [*by, "column"], "left").select(
        *by, "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, unique, top (most frequent; ties → smallest), freq per string column."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                                            for c in cols])).alias("s")).select("s.*")
    vc = stacked.where(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return vc.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("top"), F.max("n").alias("freq"))


def category_shares(df: DataFrame, col: str, by: Sequence[str] = (), dropna: bool = True) -> DataFrame:
    """Counts and share of each value (within ``by``)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    c = src.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    tot = src.groupBy(*by).agg(F.count(F.lit(1)).alias("_t"))
    j = join_on_keys(c, tot, list(by), "inner") if by else _attach_one(c, tot)
    return j.select(*by, col, "n", (F.col("n") / F.col("_t")).alias("share"))


def _attach_one(df: DataFrame, one: DataFrame) -> DataFrame:
    k = "_fw_k"
    return df.withColumn(k, F.lit(0)).join(F.broadcast(one.withColumn(k, F.lit(0))), k).drop(k)


def target_rate(df: DataFrame, by: Sequence[str], label: str = "label", min_n: int = 0) -> DataFrame:
    """Mean target and count per group; groups below ``min_n`` dropped;
    null group keys dropped (pandas group-by)."""
    src = df
    for c in by:
        src = src.where(F.col(c).isNotNull())
    out = src.groupBy(*by).agg(F.avg(F.col(label).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") >= min_n) if min_n else out


def binned_rate(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str],
                label: str = "label") -> DataFrame:
    """Right-closed fixed bins, every bin shown (empty bins: n = 0, rate null)."""
    x = F.col(col)
    b = None
    for i in range(len(edges) - 1):
        cond = (x > edges[i]) & (x <= edges[i + 1])
        b = F.when(cond, F.lit(labels[i])) if b is None else b.when(cond, F.lit(labels[i]))
    agg = (df.withColumn("bin", b).where(F.col("bin").isNotNull()).groupBy("bin")
           .agg(F.avg(F.col(label).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")))
    dims = df.sparkSession.createDataFrame([(lb, i) for i, lb in enumerate(labels)], "bin string, bin_order int")
    return dim_join(agg, dims, ["bin"], "right").select(
        "bin", "bin_order", "rate", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30, by: Sequence[str] = (),
              shared: bool = True) -> DataFrame:
    """Equal-width histogram with density over [min, max] (last bin closed), every bin shown
    (empty bins: n = 0); a column with one value has one bin.

    With ``by`` (e.g. a side column) and ``shared`` the edges come from the union of the groups."""
    by = list(by)
    stacked = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                                 for c in cols])).alias("s")).select(*by, "s.*").where(F.col("v").isNotNull())
    rng_keys = ["column"] if shared else ["column", *by]
    rng = stacked.groupBy(*rng_keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    j = dim_join(stacked, rng, rng_keys, "inner")  # one row per column (×group): bounded
    width = F.col("hi") - F.col("lo")
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / width * bins), F.lit(bins - 1))).cast("int")
    counts = j.withColumn("bin", idx).groupBy(*by, "column", "lo", "hi", "bin").agg(F.count(F.lit(1)).alias("n"))
    # every bin of every (group, column), among them the empty ones
    every = counts.select(*by, "column", "lo", "hi").distinct().withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.when(width == 0, F.lit(0)).otherwise(F.lit(bins - 1)))))
    counts = join_on_keys(every, counts.select(*by, "column", "bin", "n"), [*by, "column", "bin"], "left", null_safe=True)
    counts = counts.withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    tot = F.sum("n").over(Window.partitionBy(*by, "column"))  # ≤ bins rows per partition
    bw = F.when(width == 0, F.lit(1.0)).otherwise(width / bins)
    return counts.select(*by, "column", "bin", (F.col("lo") + F.col("bin") * bw).alias("bin_lo"), "n",
                         (F.col("n") / (tot * bw)).alias("density"))


def gaussian_kde(df: DataFrame, col: str, by: Sequence[str] = (), grid: int = 1000,
                 cut: float = 8.0, min_distinct: int = 6) -> DataFrame:
    """Gaussian KDE (Scott bandwidth ``std·n^(-1/5)``) on ``grid`` points spanning
    [min − range/2, max + range/2]; groups with fewer than ``min_distinct`` distinct values skipped.

    Distinct values (with counts) only touch grid points within ``cut`` bandwidths (a kernel term
    beyond that is below exp(-32)), so work is values × nearby points, never values × grid."""
    by = list(by)
    src = df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("v"))
    vc = src.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c"))
    st = src.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                              F.min("v").alias("lo"), F.max("v").alias("hi"))
    nd = vc.groupBy(*by).agg(F.count(F.lit(1)).alias("nd"))
    st = st.join(nd, by) if by else _attach_one(st, nd)
    st = st.where(F.col("nd") >= min_distinct).select(
        *by, "n", (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"),
        (F.col("lo") - (F.col("hi") - F.col("lo")) / 2).alias("g0"),
        ((F.col("hi") - F.col("lo")) * 2 / (grid - 1)).alias("step"))
    j = dim_join(vc, st, by, "inner") if by else _attach_one(vc, st)
    a = F.greatest(F.lit(0), F.ceil((F.col("v") - cut * F.col("h") - F.col("g0")) / F.col("step"))).cast("int")
    b = F.least(F.lit(grid - 1), F.floor((F.col("v") + cut * F.col("h") - F.col("g0")) / F.col("step"))).cast("int")
    pts = j.select(*by, "v", "c", "n", "h", "g0", "step", F.explode(F.sequence(a, b)).alias("point"))
    x = F.col("g0") + F.col("point") * F.col("step")
    z = (x - F.col("v")) / F.col("h")
    term = F.col("c") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    sums = pts.groupBy(*by, "point").agg(F.sum(term).alias("density"))
    # every grid point is reported (points far from all data have density 0)
    gridpts = st.select(*by, "g0", "step", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    out = join_on_keys(gridpts, sums, [*by, "point"], "left")
    return out.select(*by, "point", (F.col("g0") + F.col("point") * F.col("step")).alias("x"),
                      F.coalesce(F.col("density"), F.lit(0.0)).alias("density"))


def skewness_adjusted(df: DataFrame, cols: Sequence[str], log1p: bool = True) -> DataFrame:
    """Bias-adjusted (pandas) skewness, raw and after ``log1p``; Spark's ``skewness`` is the
    population g1, scaled by sqrt(n(n-1))/(n-2)."""
    def adj(e):
        n = F.count(e)
        return F.skewness(e) * F.sqrt(n * (n - 1)) / (n - 2)
    rows = []
    aggs = []
    for i, c in enumerate(cols):
        aggs += [adj(F.col(c)).alias(f"s{i}"), adj(F.log1p(F.col(c))).alias(f"l{i}")]
        rows.append((c, [F.col(f"s{i}"), F.col(f"l{i}")]))
    one = df.agg(*aggs)
    return one.select(_stack(rows, ["skew", "skew_log1p"]).alias("s")).select("s.*")


def box_summary(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, IQR, 1.5·IQR whiskers (extreme points inside the fences) and outlier count."""
    by = list(by)
    q = fold_quantiles_multi(df, [col], by, [0.25, 0.5, 0.75], None, None).drop("eval_fold")
    j = join_on_keys(df.select(*by, col).where(F.col(col).isNotNull()), q, by, "inner")
    iqr = F.col(f"{col}_q75") - F.col(f"{col}_q25")
    lo_f = F.col(f"{col}_q25") - 1.5 * iqr
    hi_f = F.col(f"{col}_q75") + 1.5 * iqr
    x = F.col(col)
    return j.groupBy(*by).agg(
        F.first(f"{col}_q25").alias("q1"), F.first(f"{col}_q50").alias("median"),
        F.first(f"{col}_q75").alias("q3"), F.first(iqr).alias("iqr"),
        F.min(F.when(x >= lo_f, x)).alias("whisker_lo"), F.max(F.when(x <= hi_f, x)).alias("whisker_hi"),
        F.sum(((x < lo_f) | (x > hi_f)).cast("long")).alias("outliers"))


def correlations(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation for every pair (one aggregation)."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]] if target is None else \
        [(c, target) for c in cols if c != target]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
                   for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])).alias("s")).select("s.*")


def two_table_numeric(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean std median min max per table and the difference of means/medians."""
    da = describe_numeric(a, cols).select("column", *[F.col(c).alias(f"{c}_a") for c in ("mean", "std", "q50", "min", "max")])
    db = describe_numeric(b, cols).select("column", *[F.col(c).alias(f"{c}_b") for c in ("mean", "std", "q50", "min", "max")])
    return da.join(db, "column").withColumn("mean_diff", F.col("mean_b") - F.col("mean_a")).withColumn(
        "median_diff", F.col("q50_b") - F.col("q50_a"))


def two_table_shares(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Shares of every value incl. null in two tables on the union vocabulary, and the diff."""
    sa = category_shares(a, col, dropna=False).select(col, F.col("share").alias("share_a"))
    sb = category_shares(b, col, dropna=False).select(col, F.col("share").alias("share_b"))
    j = sa.join(sb, sa[col].eqNullSafe(sb[col]), "full_outer").select(
        F.coalesce(sa[col], sb[col]).alias(col),
        F.coalesce(F.col("share_a"), F.lit(0.0)).alias("share_a"),
        F.coalesce(F.col("share_b"), F.lit(0.0)).alias("share_b"))
    return j.withColumn("diff", F.col("share_b") - F.col("share_a"))
