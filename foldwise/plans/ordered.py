"""Order statistics without a single-partition window.

``Window.orderBy`` without ``partitionBy`` plans ``Exchange SinglePartition``: the whole table in one
task. Every running sum here (AUC, ranks, KS, Wasserstein, exact quantiles, fold numbering) goes
through :func:`running_sum`, which first measures the largest group (one small job):

* every group has at most ``foldwise.window.maxGroupRows`` rows → a plain window partitioned by the
  group (each task holds at most that many rows);
* otherwise → ``repartitionByRange`` on (group, order) deals the rows to contiguous ranges, as many as
  keep one at half of that limit; Spark samples the bounds, so no expression holds them. Each range is
  summed per group (a table of groups + ranges rows), the sums become offsets, and a window partitioned
  by (group, range number) finishes the job. A hot group spreads over as many tasks as it needs.
  Where the order column is uniform already (a hash), the caller gives the bucket as arithmetic.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.plans.joins import max_broadcast_rows, persisted

DEFAULT_BUCKETS = 64
DEFAULT_WINDOW_MAX_ROWS = 1_000_000
_WINDOW_KEY = "foldwise.window.maxGroupRows"
_BUCKET = "_fw_bucket"
_ALL = "_fw_all"


def window_max_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(_WINDOW_KEY, str(DEFAULT_WINDOW_MAX_ROWS)))


def bucket_count(df: DataFrame, rows: int = 0) -> int:
    """Buckets or ranges of a running sum over ``rows``: at least the shuffle parallelism, and as many as
    keep one at half of ``foldwise.window.maxGroupRows`` rows."""
    try:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    except ValueError:
        parts = 8
    return max(1, parts, math.ceil(2 * rows / window_max_rows(df)))


def group_profile(df: DataFrame, group_cols: Sequence[str]) -> tuple[int, int, int]:
    """(rows in the largest group, number of groups, rows) — one two-stage job on a small table."""
    if not group_cols:
        n = df.count()
        return n, 1, n
    row = (df.groupBy(*group_cols).count()
           .agg(F.max("count").alias("m"), F.count(F.lit(1)).alias("g"), F.sum("count").alias("n")).first())
    return int(row["m"] or 0), int(row["g"] or 0), int(row["n"] or 0)


def _attach(rows: DataFrame, small: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Inner join with a table of ``n`` rows, one for each key; a null key is a key. Broadcast within the bound."""
    renamed = small.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in small.columns])
    right = F.broadcast(renamed) if n <= max_broadcast_rows(rows) else renamed
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return rows.join(right, on, "inner").drop(*[f"_r_{c}" for c in keys])


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                measures: Sequence[str], prefix: str = "cum_",
                bucket: Callable[[int], Column] | None = None,
                profile: tuple[int, int, int] | None = None) -> DataFrame:
    """Add ``prefix + m`` = sum of ``m`` over rows of the same group ordered at or before this row.

    Rows are ordered by ``order_cols``; give a unique order within a group (aggregate to distinct
    values first, or add a tiebreak column). ``bucket``: the bucket of a row among n of them, where it
    can be computed and rises with the order. ``profile``: ``group_profile`` of ``df``, where known.
    """
    group_cols, order_cols, measures = list(group_cols), list(order_cols), list(measures)
    glob = not group_cols
    if glob:
        df, group_cols = df.withColumn(_ALL, F.lit(0)), [_ALL]
    largest, n_groups, rows = profile or group_profile(df, [] if glob else group_cols)

    if largest <= window_max_rows(df):
        w = (Window.partitionBy(*group_cols).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = df.select("*", *[F.sum(m).over(w).alias(prefix + m) for m in measures])
        return out.drop(_ALL) if glob else out

    if bucket is not None:
        n = max(DEFAULT_BUCKETS, bucket_count(df, largest))
        keyed = df.withColumn(_BUCKET, bucket(n))
        n_offsets = n_groups * n
    else:
        n = bucket_count(df, rows)
        # persisted: the totals and the rows must see the same ranges
        keyed = persisted(df.repartitionByRange(n, *group_cols, *order_cols).withColumn(_BUCKET, F.spark_partition_id()))
        n_offsets = n_groups + n
    totals = keyed.groupBy(*group_cols, _BUCKET).agg(*[F.sum(m).alias(m) for m in measures])
    before = (Window.partitionBy(*group_cols).orderBy(_BUCKET)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *group_cols, _BUCKET,
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_fw_off_{m}") for m in measures])
    keys = group_cols + [_BUCKET]
    # with many groups the offsets table grows with the data: a shuffle join then
    joined = _attach(keyed, offsets, keys, n_offsets)
    local = (Window.partitionBy(*keys).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = joined.select("*", *[(F.sum(m).over(local) + F.col(f"_fw_off_{m}")).alias(prefix + m) for m in measures])
    out = out.drop(_BUCKET, *[f"_fw_off_{m}" for m in measures])
    return out.drop(_ALL) if glob else out


def value_counts(df: DataFrame, group_cols: Sequence[str], value: str,
                 weight: str | None = None) -> DataFrame:
    """Distinct (group, value) with their multiplicity (map-side combined)."""
    w = F.col(weight) if weight else F.lit(1)
    return (df.where(F.col(value).isNotNull())
            .groupBy(*group_cols, value).agg(F.sum(w).cast("long").alias("_fw_cnt")))


def exact_quantiles(df: DataFrame | None, value: str, group_cols: Sequence[str], qs: Sequence[float],
                    names: Sequence[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (the pandas / numpy default) per group.

    Works on distinct-value counts (``counts`` may pass a (group…, value, _fw_cnt) table): one running
    count finds the order statistics, so no task ever holds a large group.
    """
    names = list(names) if names else [f"q{int(round(float(q) * 100))}" for q in qs]
    vc = counts if counts is not None else value_counts(df, group_cols, value)
    return vector_quantiles(vc, value, group_cols, qs, names, ["_fw_cnt"])


def vector_quantiles(vc: DataFrame, value: str, group_cols: Sequence[str], qs: Sequence[float],
                     names: Sequence[str], counts: Sequence[str], which: str | None = None,
                     labels: Sequence | None = None) -> DataFrame:
    """Exact quantiles under several weightings at once: ``vc`` has one row per (group, value) and one
    column of multiplicities per weighting. One running sum carries all of them; a value is given out
    only where it is an order statistic that some quantile needs. With ``which`` there is one row per
    (label, group) under the weighting's ``labels`` entry, else one row per group (a single weighting).
    Groups without weight under a weighting have no row."""
    group_cols, qs, counts = list(group_cols), [float(q) for q in qs], list(counts)
    labels = list(labels) if labels is not None else [0]
    glob = not group_cols
    if glob:
        vc, group_cols = vc.withColumn(_ALL, F.lit(0)), [_ALL]
    vc = persisted(vc)
    totals = vc.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_fw_rows"), *[F.sum(c).alias(f"_fw_n{i}") for i, c in enumerate(counts)])
    # the positions that some quantile needs: a few entries per group
    need = []
    for w in range(len(counts)):
        for i, q in enumerate(qs):
            pos = (F.col(f"_fw_n{w}") - 1) * F.lit(q)
            for side, p in ((0, F.floor(pos)), (1, F.ceil(pos))):
                need.append(F.when(F.col(f"_fw_n{w}") > 0, F.struct(
                    F.lit(w).alias("w"), p.cast("long").alias("p"), F.lit(i).alias("qi"), F.lit(side).alias("side"), (pos - F.floor(pos)).alias("frac"))))
    totals = persisted(totals.select(*group_cols, "_fw_rows", F.filter(F.array(*need), lambda h: h.isNotNull()).alias("_fw_need")))
    row = totals.agg(F.max("_fw_rows"), F.count(F.lit(1)), F.sum("_fw_rows")).first()
    profile = (int(row[0] or 0), int(row[1]), int(row[2] or 0))
    cum = running_sum(vc, group_cols, [value], counts, profile=profile)
    cum = _attach(cum, totals.drop("_fw_rows"), group_cols, profile[1])
    ends, own = F.array(*[F.col(f"cum_{c}") for c in counts]), F.array(*[F.col(c) for c in counts])
    cum = cum.select(*group_cols, F.col(value).cast("double").alias("_fw_v"), "_fw_need", ends.alias("_fw_end"), own.alias("_fw_own"))
    found = F.filter("_fw_need", lambda h: (F.get("_fw_end", h.w) > h.p) & (F.get("_fw_end", h.w) - F.get("_fw_own", h.w) <= h.p))
    marked = cum.select(*group_cols, "_fw_v", F.explode(found).alias("_fw_h"))
    marked = marked.select(*group_cols, "_fw_v", *[F.col(f"_fw_h.{x}").alias(f"_fw_{x}") for x in ("w", "qi", "side", "frac")])

    def of(i: int, side: int, what: str) -> Column:
        return F.max(F.when((F.col("_fw_qi") == i) & (F.col("_fw_side") == side), F.col(what)))

    label = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("_fw_w") + 1)
    keys = ([label.alias(which)] if which else []) + [F.col(g) for g in group_cols]
    picked = marked.groupBy(*keys).agg(*[x for i in range(len(qs)) for x in (
        of(i, 0, "_fw_v").alias(f"_lo{i}"), of(i, 1, "_fw_v").alias(f"_hi{i}"), of(i, 0, "_fw_frac").alias(f"_fr{i}"))])
    res = picked.select(*([which] if which else []), *group_cols,
                        *[F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(
                            F.col(f"_lo{i}") * (1 - F.col(f"_fr{i}")) + F.col(f"_hi{i}") * F.col(f"_fr{i}")).alias(nm)
                          for i, nm in enumerate(names)])
    return res.drop(_ALL) if glob else res


def average_rank(df: DataFrame, group_cols: Sequence[str], value: str, out: str = "avg_rank",
                 pct: str | None = None) -> DataFrame:
    """pandas ``rank(method='average')`` (and ``pct=True`` when ``pct`` is named) within groups,
    computed on distinct values and joined back to the rows on (group, value). The ranks are broadcast within the
    bound: values that many rows share would meet in few tasks."""
    group_cols = list(group_cols)
    glob = not group_cols
    if glob:
        df, group_cols = df.withColumn(_ALL, F.lit(0)), [_ALL]
    vc = persisted(value_counts(df, group_cols, value))
    profile = group_profile(vc, group_cols)
    cum = running_sum(vc, group_cols, [value], ["_fw_cnt"], profile=profile)
    if pct:
        n = vc.groupBy(*group_cols).agg(F.sum("_fw_cnt").alias("_fw_n"))
        cum = _attach(cum, n, group_cols, profile[1])
    rank = F.col("cum__fw_cnt") - F.col("_fw_cnt") + (F.col("_fw_cnt") + 1) / 2.0
    cols = [*group_cols, value, rank.alias(out)]
    if pct:
        cols.append((rank / F.col("_fw_n")).alias(pct))
    ranks = cum.select(*cols)
    res = df.join(F.broadcast(ranks) if profile[2] <= max_broadcast_rows(df) else ranks, on=group_cols + [value], how="left")
    return res.drop(_ALL) if glob else res
