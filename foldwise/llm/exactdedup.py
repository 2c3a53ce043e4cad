"""Exact deduplication against a history, by a minimal perfect hash over its distinct digests.

Texts are equal if they are the same once every character of ``[\\x20\\x09-\\x0D]`` is deleted; they are
compared by the SHA-256 of what is left.  Of equal texts the row with the most code points in the original
text stays, then the smallest key (null keys last), then the first row.

``build`` deals the history's distinct digests to buckets of about ``BUCKET`` and makes one minimal perfect
hash for each: levels of bit arrays, twice as wide as the digests left, in which a digest's bit is set if no
other wants it; the digest's slot is the number of bits set before.  A slot holds the full digest and the
locator of its winner (rows so far, code points, key, row).  ``lookup`` sends new digests, combined within
every task first, to their bucket and compares the slot's digest byte by byte, since the hash sends
unknown digests to some slot too.  Members are merged with their slot's winner; the others are grouped by
digest apart.  ``dedup`` is both, and gives every row the winner of its group.

A text repeated by any share of all rows reaches a bucket as one row a task; its rows get their winner
from a broadcast of the at most ``tables.HOT`` largest groups.  Buckets grow in number, not in size; where
there are far more new digests than slots, a bucket's slots are copied to several groups.

Null texts count as empty, and empty and blank texts are equal to each other; rows that repeat a key are rows
of their own, of which one stays; an empty history or table gives an index or a result without rows;
columns beyond key and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.hashing import mix
from foldwise.llm.tables import discard, join_hot, keep

#: Slots of a bucket on average, levels of a hash (what is left then is listed), rows a task combines at once.
BUCKET, LEVELS, COMBINED = 50_000, 48, 200_000
_STEP = 0x9E3779B97F4A7C15


def _spots(digests: np.ndarray, level: int, width: int) -> np.ndarray:
    words = digests.view(np.uint64).reshape(-1, 4)
    h = mix(words[:, 0] + np.uint64((level + 1) * _STEP & (1 << 64) - 1))
    for i in (1, 2, 3):
        h = mix(h ^ words[:, i])
    return (h % np.uint64(width)).astype(np.int64)


class PerfectHash:
    """Slots 0 ... n-1 of n distinct 32-byte digests: ``levels`` are bit arrays, ``rest`` the digests that
    collided on all of them."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, {d.tobytes(): i for i, d in enumerate(rest)}
        self.before = [np.cumsum(bits) - bits for bits in levels]
        self.base = np.concatenate([[0], np.cumsum([bits.sum() for bits in levels])]).astype(np.int64)

    @staticmethod
    def of(digests: np.ndarray) -> PerfectHash:
        levels, left = [], digests
        while len(left) and len(levels) < LEVELS:
            width = -(-2 * len(left) // 64) * 64
            at = _spots(left, len(levels), width)
            alone = np.bincount(at, minlength=width) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return PerfectHash(levels, left)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for some that aren't members (others get a member's slot)."""
        out, active = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for i, bits in enumerate(self.levels):
            at = _spots(digests[active], i, len(bits))
            hit = bits[at]
            out[active[hit]] = self.base[i] + self.before[i][at[hit]]
            active = active[~hit]
        for i in active if self.rest else ():
            out[i] = self.base[-1] + self.rest.get(digests[i].tobytes(), -1 - self.base[-1])
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Binary values of 32 bytes as rows of a matrix."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.binary(32))
    return np.frombuffer(column.buffers()[1], np.uint8)[32 * column.offset : 32 * (column.offset + len(column))].reshape(-1, 32).copy()


def _best() -> Column:
    return F.min(F.struct("c", "nul", "id", "row")).alias("b")


def _flat(df: DataFrame, *first: str) -> DataFrame:
    return df.select(*first, "n", "b.c", "b.nul", "b.id", "b.row")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, nul, c, digest) of every row, kept: the one pass over the texts.  ``c`` is less the longer a text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(whole, " \t\n\x0b\x0c\r", "")
    return keep(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(key).isNull().alias("nul"),
                            (-F.length(whole)).cast("long").alias("c"), F.unhex(F.sha2(bare, 256)).alias("digest")), "digests")


def build(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The index of ``rows`` (as ``digests`` gives them), one row a bucket: (bucket, buckets, size, levels,
    bits, rest, slots, winners).  Kept in the shared folder."""
    distinct = keep(_flat(rows.groupBy("digest").agg(F.count("*").alias("n"), _best()), "digest"), "distinct")
    buckets = max(1, -(-distinct.count() // bucket))
    kind = rows.schema["id"].dataType.simpleString()

    def hashed(part: pa.Table) -> pa.Table:
        known = _matrix(part["digest"])
        made = PerfectHash.of(known)
        order = np.argsort(made.slots(known))
        placed = part.take(pa.array(order)).combine_chunks()
        winners = pa.StructArray.from_arrays([placed[c].combine_chunks() for c in ("n", "c", "nul", "id", "row")], ["n", "c", "nul", "id", "row"])
        bits = np.packbits(np.concatenate([*made.levels, np.zeros(0, bool)])).tobytes()
        return pa.table({"bucket": [part["bucket"][0].as_py()], "buckets": [buckets], "size": [len(order)], "levels": [[len(x) for x in made.levels]], "bits": [bits],
                         "rest": [b"".join(made.rest)], "slots": [known[order].tobytes()], "winners": pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), winners)})

    schema = f"bucket long, buckets long, size long, levels array<long>, bits binary, rest binary, slots binary, winners array<struct<n: long, c: long, nul: boolean, id: {kind}, row: long>>"
    dealt = distinct.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    index = keep(dealt.groupBy("bucket").applyInArrow(hashed, schema), "index")
    discard(distinct)
    return index


def _combined(rows: DataFrame) -> DataFrame:
    """``rows`` with equal digests of a task's ``COMBINED`` rows made one: (digest, n, c, nul, id, row)."""
    kind = rows.schema["id"].dataType.simpleString()
    names = ["digest", "c", "nul", "id", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            part = pa.Table.from_batches(held).sort_by([(x, "ascending") for x in names]).combine_chunks()
            known = _matrix(part["digest"])
            starts = np.flatnonzero(np.concatenate([[True], (known[1:] != known[:-1]).any(axis=1)]))
            firsts = part.take(pa.array(starts))
            n = np.diff(np.append(starts, len(known)))
            yield from firsts.add_column(1, "n", pa.array(n, pa.int64())).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= COMBINED:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return rows.select(*names).mapInArrow(run, f"digest binary, n long, c long, nul boolean, id {kind}, row long")


def lookup(rows: DataFrame, index: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``rows`` (as ``digests`` gives them), combined within tasks, with the bucket and slot of those whose
    digest the index holds (null for others): (digest, n, c, nul, id, row, bucket, slot).  Kept."""
    few = keep(_combined(rows), "combined")
    buckets = (index.agg(F.max("buckets")).first()[0]) or 1
    copies = max(1, few.count() // (4 * bucket * buckets))
    kind = rows.schema["id"].dataType.simpleString()
    columns = ["bucket", "digest", "n", "c", "nul", "id", "row"]

    def look(new: pa.Table, slots: pa.Table) -> pa.Table:
        new = new.select(columns)
        slot = pa.nulls(len(new), pa.int64())
        if len(slots) and len(new):
            one = slots.slice(0, 1).to_pylist()[0]
            widths = one["levels"]
            bits = np.unpackbits(np.frombuffer(one["bits"], np.uint8), count=sum(widths)).astype(bool)
            known = np.frombuffer(one["slots"], np.uint8).reshape(-1, 32)
            made = PerfectHash(np.split(bits, np.cumsum(widths)[:-1]) if widths else [], np.frombuffer(one["rest"], np.uint8).reshape(-1, 32))
            asked = _matrix(new["digest"])
            at = made.slots(asked)
            same = (at >= 0) & (known[np.maximum(at, 0)] == asked).all(axis=1)
            slot = pa.array(at, mask=~same)
        return new.append_column("slot", slot)

    dealt = few.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets))).withColumn("copy", F.pmod(F.col("row"), F.lit(copies)))
    held = index.select("bucket", "levels", "bits", "rest", "slots").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    found = dealt.groupBy("bucket", "copy").cogroup(held.groupBy("bucket", "copy")).applyInArrow(look, f"bucket long, digest binary, n long, c long, nul boolean, id {kind}, row long, slot long")
    found = keep(found, "found")
    discard(few)
    return found


def winners(found: DataFrame, index: DataFrame) -> DataFrame:
    """(digest, n, c, nul, id, row) of every distinct digest of the index and of ``found`` (from ``lookup``):
    members merged into their slots, the others grouped apart."""
    slots = index.select("bucket", F.posexplode("winners").alias("slot", "w"), "slots")
    slots = slots.select("bucket", F.col("slot").cast("long").alias("slot"), F.expr("substring(slots, 32 * slot + 1, 32)").alias("digest"), "w.*")
    members = found.where("slot is not null").select("bucket", "slot", "digest", "n", "c", "nul", "id", "row")
    merged = slots.unionByName(members).groupBy("bucket", "slot").agg(F.min("digest").alias("digest"), F.sum("n").alias("n"), _best())
    others = found.where("slot is null").groupBy("digest").agg(F.sum("n").alias("n"), _best())
    return _flat(merged, "digest").unionByName(_flat(others, "digest"))


def dedup(docs: DataFrame, is_history: Column, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(``key``, keep, group_size, kept, digest) of every row of ``docs``: an index is built over the rows of
    the history, and all others are looked up in it.  ``is_history`` is a condition on ``key`` and ``text``
    (null: not history)."""
    marked = docs.select(F.col(key), F.col(text), F.coalesce(is_history, F.lit(False)).alias("_old"))
    old, new = (digests(marked.where(side), key, text) for side in ("_old", "not _old"))
    # rows are numbered within each side
    old_rows, new_rows = old.withColumn("row", -1 - F.col("row")), new
    index = build(old_rows, bucket)
    found = lookup(new_rows, index, bucket)
    best = keep(winners(found, index).where("n > 1").select("digest", F.col("n").alias("rows"), "n", F.col("id").alias("keep"), F.col("row").alias("first")), "winners")
    discard(index, found)
    out = join_hot(old_rows.unionByName(new_rows), best, "digest", "rows")
    alone = F.col("first").isNull()
    return out.select(F.col("id").alias(key), F.when(alone, F.col("id")).otherwise(F.col("keep")).alias("keep"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                      (alone | (F.col("first") == F.col("row"))).alias("kept"), "digest")
