"""Isotonic regression by pool-adjacent-violators on value ranges, merged pairwise.

The fit of a sorted sequence is a list of blocks (range, weighted mean); the fit of two sequences after one
another is the pooling of their block lists, so ranges are fitted on their own and their lists merged, a few
neighbours a task and round, until one list is left. A task holds one range's distinct scores, or the blocks
of a few ranges, never all scores; a range holds ``foldwise.window.maxGroupRows`` rows at most, half on average.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.plans.joins import max_broadcast_rows
from foldwise.plans.ordered import bucket_count
from foldwise.plans.session import cut_lineage

#: Neighbouring lists that one task merges.
FAN = 16
_FIELDS = [("part", pa.int64()), ("key", pa.string()), ("lo", pa.float64()), ("hi", pa.float64()), ("s", pa.float64()), ("n", pa.float64())]
_DDL = "part long, key string, lo double, hi double, s double, n double"


def pool(lo: Sequence[float], hi: Sequence[float], s: Sequence[float], n: Sequence[float]) -> list[tuple]:
    """Blocks in order → blocks whose means rise: neighbours that don't are pooled. Equal means stay apart only
    as long as no violator pools them."""
    out: list[list[float]] = []
    for a, b, total, count in zip(lo, hi, s, n):
        block = [a, b, total, count]
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:  # its mean is not above the last one's
            last = out.pop()
            block = [last[0], block[1], last[2] + block[2], last[3] + block[3]]
        out.append(block)
    return [tuple(b) for b in out]


def _pooled(part_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks(key, rows, part):
            found = pool(*([r[i] for r in rows] for i in range(4)))
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays([pa.array([part] * len(found), pa.int64()), pa.array([key] * len(found), pa.string()),
                                               *(pa.array(c, pa.float64()) for c in columns)], schema=pa.schema(_FIELDS))

        key, rows, part = None, [], None
        for batch in batches:
            names = batch.schema.names
            columns = [batch.column(names.index(c)).to_pylist() for c in ("key", "lo", "hi", "s", "n")]
            parts = batch.column(names.index("part")).to_pylist()
            for p, k, *row in zip(parts, *columns):
                if rows and (k != key or part_of(p) != part):
                    yield blocks(key, rows, part)
                    rows = []
                key, part = k, part_of(p)
                rows.append(row)
        if rows:
            yield blocks(key, rows, part)

    return run


def fit_isotonic(df: DataFrame, score: str, label: str, by: str | None = None, ranges: int | None = None) -> DataFrame:
    """(key, lo, hi, value, n): the rising steps of the mean label over the score, per value of ``by`` (as a
    string; one key '' without). Rows with a null score or label teach nothing; ties are one point."""
    key = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(key.alias("key"), F.col(score).cast("double").alias("lo"), F.col(label).cast("double").alias("y"))
    points = rows.groupBy("key", "lo").agg(F.sum("y").alias("s"), F.count("*").cast("double").alias("n"))
    points = points.select(F.lit(0).cast("long").alias("part"), "key", "lo", F.col("lo").alias("hi"), "s", "n")
    parts = ranges or bucket_count(points, rows.count())
    sorted_ = points.repartitionByRange(parts, "key", "lo").sortWithinPartitions("key", "lo")
    own = lambda p: TaskContext.get().partitionId()
    lists = cut_lineage(sorted_.mapInArrow(_pooled(own), _DDL))
    while parts > 1:
        parts = -(-parts // FAN)
        dealt = lists.withColumn("part", F.floor(F.col("part") / FAN).cast("long"))
        dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "key", "lo")
        lists = cut_lineage(dealt.mapInArrow(_pooled(lambda p: p), _DDL))
    return lists.select("key", "lo", "hi", (F.col("s") / F.col("n")).alias("value"), "n")


def apply_isotonic(df: DataFrame, steps: DataFrame, score: str, out: str = "prob", by: str | None = None) -> DataFrame:
    """``df`` with ``out``: the step of the score, between two steps the straight line, beyond the ends the
    nearest. Null scores and unknown keys give null. The steps are broadcast behind a check of their number."""
    count = steps.count()
    if count > max_broadcast_rows(steps):
        raise ValueError(f"{count} steps are too many for a calibrator")
    known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    rows = steps.select("key", "lo", "hi", "value").orderBy("key", "lo").collect()
    for k in {r["key"] for r in rows}:
        own = [r for r in rows if r["key"] == k]
        known[k] = (np.array([x for r in own for x in (r["lo"], r["hi"])]), np.array([r["value"] for r in own for _ in range(2)]))
    shared = df.sparkSession.sparkContext.broadcast(known)
    at = "_fw_key"
    given = df.withColumn(at, F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit(""))
    fields = [f for f in df.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            x = np.array([np.nan if v is None else float(v) for v in table[score].to_pylist()])
            keys = np.array(table[at].to_pylist(), object)
            y = np.full(len(x), np.nan)
            for k in set(keys.tolist()) & shared.value.keys():
                mine = (keys == k) & ~np.isnan(x)
                y[mine] = np.interp(x[mine], *shared.value[k])
            table = table.select([f.name for f in fields]).append_column(out, pa.array(y, pa.float64(), mask=np.isnan(y)))
            yield from table.to_batches()

    from pyspark.sql import types as T

    return given.select(*[f.name for f in fields], *([score] if score == out else []), at).mapInArrow(run, T.StructType(fields + [T.StructField(out, T.DoubleType())]))
