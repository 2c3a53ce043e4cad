"""Many independent fits: rows read once for all fits that share them, and small fits side by side.

An iteration of a learner is a Spark job; on small tables the cost of a job, not the rows, takes the time. So the
fits of a search run in threads (as Spark's ``CrossValidator`` does with ``parallelism``) as long as their rows
together stay under ``ROWS_AT_ONCE``, and a fit's rows lie in no more partitions than they need. Large fits fill
the cluster by themselves and run one after the other. The driver holds models only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.models import assembler, positive_probability
from foldwise.plans.joins import packed

#: Fits in threads at the same time, and the rows of all of them.
SIDE_BY_SIDE, ROWS_AT_ONCE = 20, 8_000_000


class Group(NamedTuple):
    """Training rows, their number, and the fits on them: (feature columns, estimator) each."""
    rows: DataFrame
    n: int
    fits: Sequence[tuple[Sequence[str], object]]


def side_by_side(spark: SparkSession, calls: Sequence[Callable[[], object]], width: int) -> list:
    """Results of the calls, in their order, ``width`` at a time."""
    if width <= 1 or len(calls) <= 1:
        return [c() for c in calls]
    with ThreadPoolExecutor(min(width, len(calls))) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]


def fit_groups(groups: Sequence[Group], keep: Sequence[str] = ("label",)) -> list[list]:
    """The fitted models of every group. A group's rows (the columns its fits use, and ``keep``) are read once."""
    width = max(1, min(SIDE_BY_SIDE, ROWS_AT_ONCE // max(1, *(g.n for g in groups))))
    within, spark = max(1, width // len(groups)), groups[0].rows.sparkSession

    def fit(g: Group) -> list:
        used = list(dict.fromkeys([*keep, *(c for cols, _ in g.fits for c in cols)]))
        bagged = any(hasattr(est, "getSubsamplingRate") for _, est in g.fits)
        rows = packed(g.rows.select(*used), g.n, bagged).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return side_by_side(spark, [lambda cols=cols, est=est: est.fit(assembler(cols).transform(rows)) for cols, est in g.fits], within)
        finally:
            rows.unpersist()

    return side_by_side(spark, [lambda g=g: fit(g) for g in groups], width)


def score_all(rows: DataFrame, models: Sequence[tuple[str, Sequence[str], object]], keep: Sequence[str]) -> DataFrame:
    """(keep…, model, prob): the rows scored by all models, (name, feature columns, model) each, in one scan."""
    columns, probs = list(dict.fromkeys([*keep, *(c for _, cols, _ in models for c in cols)])), []
    df = rows.select(*columns)
    for i, (_, cols, model) in enumerate(models):
        df = positive_probability(model.transform(assembler(cols).transform(df)), f"_fw_prob{i}")
        probs.append(f"_fw_prob{i}")
        df = df.select(*columns, *probs)
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.col(p).alias("prob")) for (name, _, _), p in zip(models, probs)]))
    return df.select(*keep, each.alias("_fw_m")).select(*keep, "_fw_m.model", "_fw_m.prob")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
