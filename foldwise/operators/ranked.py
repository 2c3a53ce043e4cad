"""Exact AUCs of many blends of the same rows, without a row for every row and blend.

A task computes the blends of its rows as arrays and deals them to ranges of each blend's scores; a range is sorted by
itself, and pairs of different ranges follow from the ranges' counts. What is shuffled is ten bytes a row and blend,
and blends go in turns of a bounded number of scores, each turn's files deleted when it has ended.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Scores of one turn, and rows whose scores lie in one range.
TURN, RANGE_ROWS = 200_000_000, 200_000
#: Shuffle files of a turn go when it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def blend(columns: Sequence[np.ndarray], weights: Sequence[float]) -> np.ndarray:
    """Σ w·column, added in the order of the columns; below all others where a column is missing (null)."""
    s = float(weights[0]) * columns[0]
    for w, c in zip(weights[1:], columns[1:]):
        s = s + float(w) * c
    return s


def _narrow(counts: np.ndarray) -> bytes:
    """Counts with their width before them: a byte each, if they fit."""
    kind = np.uint8 if not len(counts) or counts.max() < 256 else np.float64
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if data[0] == 1 else np.float64, offset=1).astype(np.float64)


def blend_aucs(tuples: DataFrame, cols: Sequence[str], grid: Mapping[int, Sequence[float]], pos: str, neg: str) -> DataFrame:
    """(grid_id, auc): the AUC of Σ w·col of every point over rows that stand for ``pos`` positives and ``neg`` negatives,
    ties counted ½; null with one class, no row without any. ``tuples`` is read several times (persist it)."""
    spark, cols, n = tuples.sparkSession, list(cols), tuples.count()
    rows = tuples.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)),
                         F.reduce(F.array(*(F.col(c).isNull() for c in cols)), F.lit(False), lambda a, x: a | x).alias("none"), F.col(pos).alias("p"), F.col(neg).alias("n"))
    ranges, bounds = max(1, math.ceil(n / RANGE_ROWS)), {g: np.empty(0) for g in grid}
    if ranges > 1:  # from a few thousand rows: any bounds are right, these deal the scores evenly
        share = max(1, int((1 << 20) * min(1.0, 20_000 / n)))
        some = rows.where(~F.col("none") & (F.pmod(F.xxhash64(*(f"c{i}" for i in range(len(cols)))), F.lit(1 << 20)) < share)).limit(100_000).collect()
        if some:
            x = [np.array([r[i] for r in some]) for i in range(len(cols))]
            bounds = {g: np.unique(np.quantile(blend(x, ws), np.arange(1, ranges) / ranges, method="nearest")) for g, ws in grid.items()}

    def turn(points: Mapping[int, Sequence[float]]) -> DataFrame:
        own = {g: bounds[g] for g in points}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = [batch.column(f"c{i}").fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(len(cols))]
                none, p, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("none", "p", "n"))
                out: dict[str, list] = {c: [] for c in ("grid_id", "range", "s", "p", "n")}
                for g, ws in points.items():
                    s = blend(x, ws)
                    s[none] = -np.inf
                    place = np.searchsorted(own[g], s, "right")
                    order = np.argsort(place, kind="stable")
                    ends = np.searchsorted(place[order], np.arange(len(own[g]) + 2))
                    for r in range(len(own[g]) + 1):
                        at = order[ends[r] : ends[r + 1]]
                        if len(at):
                            for c, v in zip(out, (g, r, s[at].tobytes(), _narrow(p[at]), _narrow(n[at]))):
                                out[c].append(v)
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

        def count(group: pa.Table) -> pa.Table:
            s = np.frombuffer(b"".join(group.column("s").to_pylist()))
            p, n = (np.concatenate([_wide(d) for d in group.column(c).to_pylist()]) for c in ("p", "n"))
            order = np.argsort(s)
            s, p, n = s[order], p[order], np.concatenate([[0.0], np.cumsum(n[order])])
            below, upto = n[np.searchsorted(s, s, "left")], n[np.searchsorted(s, s, "right")]
            keys = {c: group.column(c)[:1] for c in ("grid_id", "range")}
            return pa.table({**keys, "p": [p.sum()], "n": [n[-1]], "u": [(p * (below + 0.5 * (upto - below))).sum()]})

        dealt = rows.mapInArrow(run, "grid_id int, range int, s binary, p binary, n binary")
        parts = dealt.groupBy("grid_id", "range").applyInArrow(count, "grid_id int, range int, p double, n double, u double")
        lower = F.sum("n").over(Window.partitionBy("grid_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # of the ranges
        parts = parts.withColumn("u", F.col("u") + F.col("p") * F.coalesce(lower, F.lit(0.0)))
        return parts.groupBy("grid_id").agg(F.try_divide(F.sum("u"), F.sum("p") * F.sum("n")).alias("auc"))

    width = max(1, TURN // max(1, n))
    if width >= len(grid):
        return turn(grid)
    found, ids, before = [], list(grid), spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        for at in range(0, len(ids), width):
            found += [(r["grid_id"], r["auc"]) for r in turn({g: grid[g] for g in ids[at : at + width]}).collect()]  # a number a point
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.createDataFrame(found, "grid_id int, auc double")
