"""Joins against derived statistics tables.

Statistics tables (per group, per fold, per grid point) come out of an aggregation, so Catalyst
cannot estimate their size and would plan a sort-merge join that shuffles the big side. We
materialise the small side once, count it, and broadcast it only when the count is under a bound;
otherwise the join stays a shuffle join (and AQE may still split skewed partitions).
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
_MAX_ROWS_KEY = "foldwise.broadcast.maxRows"

_persisted: list[DataFrame] = []


def max_broadcast_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(_MAX_ROWS_KEY, str(DEFAULT_MAX_BROADCAST_ROWS)))


def sized(small: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Persist ``small`` and report whether its checked row count allows a broadcast."""
    limit = max_rows if max_rows is not None else max_broadcast_rows(small)
    small = small.persist(StorageLevel.MEMORY_AND_DISK)
    _persisted.append(small)
    n = small.count()
    return small, n <= limit


def persisted(df: DataFrame) -> DataFrame:
    """Persist an intermediate that several jobs of one operator re-read (a distinct-value table,
    a statistics table). Spills to disk; lost blocks are recomputed from lineage."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _persisted.append(df)
    return df


#: Rows of an iterated table that are worth a task of their own.
ROWS_PER_TASK = 50_000


def packed(rows: DataFrame, n: int, bagged: bool = True) -> DataFrame:
    """``rows`` (``n`` of them) in no more partitions than one for ``ROWS_PER_TASK`` rows; with ``bagged`` two a core
    may stay, since the bagging of the tree learners depends on the partitions."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(2 * cores if bagged else 1, math.ceil(n / ROWS_PER_TASK)))


def stat_join(big: DataFrame, small: DataFrame, on, how: str = "left",
              max_rows: int | None = None) -> DataFrame:
    """Join ``big`` to a statistics table, broadcasting the table only behind a row-count check."""
    small, ok = sized(small, max_rows)
    return big.join(F.broadcast(small) if ok else small, on=on, how=how)


def dim_join(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Join to a table whose size is bounded by construction (a parameter grid, a list of
    quantiles, a fold list): broadcast without a count."""
    return big.join(F.broadcast(small), on=on, how=how)


def null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def release() -> None:
    """Unpersist every statistics table materialised by ``stat_join``."""
    while _persisted:
        try:
            _persisted.pop().unpersist()
        except Exception:  # session may already be gone
            pass


def join_on_keys(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
                 null_safe: bool = False, checked: bool = True, max_rows: int | None = None) -> DataFrame:
    """Equi-join on ``keys`` keeping one copy of each key. ``null_safe`` makes null keys match
    (pandas merge / group-by-as-string semantics); ``checked`` broadcasts the small side only behind
    its row count (``False`` = size bounded by construction)."""
    if checked:
        small, ok = sized(small, max_rows)
    else:
        ok = True
    right = F.broadcast(small) if ok else small
    if not null_safe:
        return big.join(right, on=keys, how=how)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in small.columns])
    cond = None
    for c in keys:
        t = big[c].eqNullSafe(renamed[f"_r_{c}"])
        cond = t if cond is None else cond & t
    return big.join(renamed, on=cond, how=how).drop(*[f"_r_{c}" for c in keys])
