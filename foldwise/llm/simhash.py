"""SimHash document fingerprints and their search by permuted block tables.

Terms are pairs of adjacent words (lower-cased A-Z, split at white space; a one-word text is one term),
weighted by 1 + ln(times in the text).  Each term's 128-bit hash votes with its weight for or against
every bit; the signs of the sums are the fingerprint, kept as two longs.  A text without words has all
bits 0, and null counts as empty.  Likeness of two fingerprints is the cosine of the angle that their
Hamming distance stands for, cut at 0: equal texts have 1, unrelated texts about 0.

Search: the bits are cut into blocks; fingerprints within ``radius`` bits differ in at most ``radius``
blocks, so with ``blocks`` of them they agree in ``blocks - radius``.  One table for each choice of that
many blocks, keyed by them, finds all such pairs; the distance is then checked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.hashing import chunks, mix, shingles, words
from foldwise.llm.tables import BROADCAST_ROWS, ensure_checkpoint_dir

CHUNK = 1 << 18
BITS = 128
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def sketch(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, 2) longs: the fingerprints of the texts of a chunk."""
    n = len(offsets) - 1
    h, doc = words(raw, offsets)
    h, doc = shingles(h, doc, n, 2)
    out = np.zeros((n, 2), np.int64)
    if not len(h):
        return out
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
    times = np.diff(np.append(first, len(h)))
    h, doc = h[first], doc[first]
    order = np.lexsort((times, doc))
    h, doc, times = h[order], doc[order], times[order]
    both = np.stack([h, mix(h * _SECOND)], 1)
    bits = np.unpackbits(both.view(np.uint8).reshape(len(h), BITS // 8), axis=1)
    # terms of one document and weight are counted together, eight bits of them in one addition, at most 255 terms at once
    start = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (times[1:] != times[:-1])]))
    size = np.diff(np.append(start, len(h)))
    parts = -(-size // 255)
    block = np.repeat(start, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    n_set = np.add.reduceat(bits.view(np.uint64), block, axis=0).view(np.uint8)
    n_all = np.diff(np.append(block, len(h)))
    doc, weight = doc[block], 1 + np.log(times[block])
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    votes = np.add.reduceat((2.0 * n_set - n_all[:, None]) * weight[:, None], begin, axis=0)
    out[doc[begin]] = np.packbits(votes > 1e-4, axis=1).view(np.int64)
    return out


def simhash(docs: DataFrame, text: str = "text", hi: str = "hi", lo: str = "lo") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` added as longs ``hi``, ``lo``."""
    rest = [c for c in docs.columns if c not in (hi, lo)]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(hi, T.LongType(), False), T.StructField(lo, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, text, CHUNK):
                prints = sketch(raw, offsets)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in rest), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy())], [*rest, hi, lo])

    return docs.select(*rest).mapInArrow(run, schema)


def fingerprint(hi: str, lo: str) -> Column:
    """32 hex digits."""
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(hi: str, lo: str, hi2: str, lo2: str) -> Column:
    return F.bit_count(F.col(hi).bitwiseXOR(F.col(hi2))) + F.bit_count(F.col(lo).bitwiseXOR(F.col(lo2)))


def likeness(d: Column) -> Column:
    return F.greatest(F.lit(0.0), F.cos(d * F.lit(math.pi / BITS)))


def with_next(docs: DataFrame, order: str, text: str, carry: list[str], make, keys: DataFrame | None = None) -> DataFrame:
    """Hands each row and the row after it in ascending ``order`` (after the last: the first) to
    ``make(texts, next_texts) -> texts``; gives ``order``, ``carry``, ``next_``-prefixed ``carry`` and
    the made text as ``made``.

    Rows are dealt to ranges of ``order``, one shuffle of the texts, and sorted within them; the first
    row of each range also goes to the end of the range before, so no range needs another one.  The
    driver sees the bounds and first keys of the ranges only.  Rows of equal ``order`` come by hash of
    their text; null ``order`` comes first.  A single row follows itself.
    ``keys``: the same rows before ``carry`` was computed, if that is costly; the ranges are laid out by them.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(F.coalesce(text, F.lit(""))).alias("_tie")
    keyed, plain = docs.select(order, text, *carry, tie), (docs if keys is None else keys).select(order, tie)
    bounds = plain.select(F.percentile_approx(order, F.array([F.lit(i / n) for i in range(1, n)]), 10000) if n > 1 else F.lit(None)).first()[0] or []
    bounds = sorted(set(bounds))
    rank = F.lit(0)
    if bounds:
        rank = F.coalesce(F.size(F.filter(F.array([F.lit(b) for b in bounds]), lambda b: b < F.col(order))), F.lit(0))
        rank = F.when(F.col(order).isNull(), F.lit(0)).otherwise(rank)
    keyed, plain = keyed.withColumn("_range", rank), plain.withColumn("_range", rank)
    firsts = sorted(plain.groupBy("_range").agg(F.min(F.struct(F.col(order).isNotNull().alias("a"), F.col(order).alias("b"), F.col("_tie").alias("c"))).alias("f")).collect())
    if not firsts:
        firsts = [(0, (True, None, 0))]
    moved = None
    for i, (_, (_, key, tie)) in enumerate(firsts):
        here = F.col(order).eqNullSafe(F.lit(key)) & (F.col("_tie") == tie)
        moved = F.when(here, F.lit(firsts[i - 1][0])) if moved is None else moved.when(here, F.lit(firsts[i - 1][0]))
    rows = (keyed.withColumn("_copy", moved)
            .withColumn("_at", F.explode(F.when(F.col("_copy").isNull(), F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("z"))))
                                         .otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("z")), F.struct(F.col("_copy").alias("r"), F.lit(1).alias("z"))))))
            .select(F.col("_at.r").alias("_range"), F.col("_at.z").alias("_copied"), "_tie", order, text, *carry)
            .repartition(n, "_range").sortWithinPartitions("_range", "_copied", F.asc_nulls_first(order), "_tie"))
    schema = T.StructType([docs.schema[order], *(docs.schema[c] for c in carry),
                           *(T.StructField(f"next_{c}", docs.schema[c].dataType) for c in carry), T.StructField("made", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, len(batch), 512):
                table = pa.Table.from_batches([batch.slice(at, 512)])
                if held is not None:
                    table = pa.concat_tables([held, table])
                held = table.slice(len(table) - 1)
                yield from follow(table)

    def follow(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        left, right = table.slice(0, len(table) - 1), table.slice(1)
        which = np.flatnonzero((left["_range"].to_numpy() == right["_range"].to_numpy()) & (left["_copied"].to_numpy() == 0))
        if not len(which):
            return
        left, right = left.take(pa.array(which)), right.take(pa.array(which))
        made = make([t or "" for t in left[text].to_pylist()], [t or "" for t in right[text].to_pylist()])
        out = pa.Table.from_arrays([left[order], *(left[c] for c in carry), *(right[c] for c in carry), pa.array(made, pa.string())], names=schema.names)
        yield from out.combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def swap_tail(texts: list[str], after: list[str]) -> list[str]:
    """The last quarter of each text replaced by as much of the beginning of the text after it."""
    return [t[: len(t) - len(t) // 4] + u[: len(t) // 4] for t, u in zip(texts, after)]


def _blocks(hi: str, lo: str, blocks: int) -> list[Column]:
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    out = []
    for a, b in zip(edges, edges[1:]):
        parts = []
        for column, base in ((lo, 0), (hi, 64)):
            x, y = max(a, base) - base, min(b, base + 64) - base
            if x < y:
                parts.append(F.shiftrightunsigned(F.shiftleft(column, 64 - y), 64 - (y - x)))
        out.append(F.struct(*parts) if len(parts) > 1 else parts[0])
    return out


def within(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5, hi: str = "hi", lo: str = "lo") -> DataFrame:
    """(q_hi, q_lo, hi, lo, distance, rows): for each distinct fingerprint of ``queries`` the distinct
    fingerprints of ``prints`` within ``radius`` bits and how many rows have them.  Equal fingerprints
    meet once, so a group of copies costs one entry."""
    if blocks <= radius:
        raise ValueError("there must be more blocks than bits of the radius")
    tables = list(combinations(range(blocks), blocks - radius))

    def keyed(df: DataFrame) -> DataFrame:
        parts = _blocks(hi, lo, blocks)
        keys = [F.struct(F.lit(i).alias("t"), F.xxhash64(*(parts[j] for j in t)).alias("k")) for i, t in enumerate(tables)]
        return df.select("*", F.explode(F.array(keys)).alias("key"))

    distinct = prints.groupBy(hi, lo).agg(F.count("*").alias("rows"))
    asked = queries.select(hi, lo).distinct()
    n = asked.count()
    asked = keyed(asked).select(F.col(hi).alias("q_hi"), F.col(lo).alias("q_lo"), "key")
    asked = F.broadcast(asked) if n * len(tables) <= BROADCAST_ROWS else asked
    found = keyed(distinct).join(asked, "key").withColumn("distance", distance(hi, lo, "q_hi", "q_lo"))
    return found.where(F.col("distance") <= radius).select("q_hi", "q_lo", hi, lo, "distance", "rows").distinct()
