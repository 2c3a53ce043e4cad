"""The trie of all conversations' turn prefixes, by union-find over the LCP edges of their sorted order.

A conversation is the sequence of its turns' keys (128 bits of the SHA-256 of role and text), so the trie is
read off the sorted order: neighbours with ``d`` leading turns in common share the nodes of depth 0 to d.
Conversations are sorted by sequence and id over as many range partitions as there are blocks of ``TURNS``
turns; copies of one conversation are parted by their ids.

Within a block the edges between neighbours are taken in descending depth.  A component of the union-find
is a run of neighbours, held by its top node; before two components merge at depth d, each is lowered
there, one node a step, and their merge is the branching node of depth d.  A node that holds neither the
block's first nor its last conversation is closed: nothing outside belongs to it, and its row is written.
What remains of a block is contracted to the paths of its first and last conversation, where each open node
has the sums of what is closed below it.  The paths of ``FAN`` blocks after one another are merged in the
same way, and so on, until the last merge closes the root.  So a task holds one block, or ``2 * FAN`` paths.

A row whose parent was still open gets the parent's smallest member by a join on the parent's prefix hash;
the few parents with a large share of all rows are broadcast.  The ids that end in an open node are written
in pieces, one a block, and hashed one after another in the end, since SHA-256 can't be merged: the hash of
a conversation that a third of all rows repeat is one task's matter, which reads a piece at a time.

``rebuilt`` needs the turns of a conversation together, as keys and sizes (about 40 bytes a turn), not as
texts.  Turns with a null ``conv_id`` belong to no conversation and are left out; null roles and texts
count as empty; turns with equal numbers follow one another by their keys; repeated rows are turns of
their own; an empty table has no nodes; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.tables import discard, join_hot, keep

#: Turns (and conversations) of a block, blocks merged by one task, heads taken over.
TURNS, FAN, HEADS = 200_000, 64, 8
_KEY = 16
_NODE, _PATH, _PIECE = 0, 1, 2
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("side", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                     ("pid", pa.binary()), ("id", pa.binary()), ("key", pa.binary()), ("size", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                     ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("pieces", pa.bool_())])
_DDL = ("kind int, part long, side int, conv_id long, depth long, parent_conv_id long, pid binary, id binary, key binary, size long, n_convs long, n_children long, "
        "n_leaves long, saved long, ends string, pieces boolean")
_NONE = hashlib.sha256().hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (key, size)) of every conversation of (conv_id, turn, role, text), in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * _KEY)
    each = turns.where("conv_id is not null").select("conv_id", F.struct("turn", key.alias("key"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    return each.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t"), _nulls_first), lambda t: F.struct(t.key.alias("key"), t.size.alias("size"))).alias("turns"))


def _nulls_first(a, b):
    earlier = (a.turn.isNull() & b.turn.isNotNull()) | (a.turn < b.turn)
    later = (b.turn.isNull() & a.turn.isNotNull()) | (a.turn > b.turn)
    return F.when(earlier, -1).when(later, 1).when(a.key < b.key, -1).when(a.key > b.key, 1).otherwise(0)


def rebuilt(turns: DataFrame, family: int = 5, heads: int = HEADS) -> DataFrame:
    """(conv_id, key, sizes): every conversation c with its first h turns replaced by those of conversation
    c - c % ``family``; h = crc32(c) % (``heads`` + 1).  ``key`` is the keys of all turns, joined."""
    own = keep(sequences(turns), "sequences")
    first = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads).alias("head"))
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(first, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (heads + 1)).cast("int")
    all_ = F.concat(F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    both = both.withColumn("h", h).select("conv_id", all_.alias("t"))
    out = keep(both.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t.key), "")).alias("key"), F.transform("t", lambda t: t.size).alias("sizes")), "rebuilt")
    discard(own)
    return out


class _Top:
    """A node under construction: what is known of its members, children and the subtree below."""

    __slots__ = ("n", "least", "children", "leaves", "saved", "ends", "pieces", "rows")

    def __init__(self, n=0, least=None, children=0, leaves=0, saved=0, ends=(), pieces=False, rows=()):
        self.n, self.least, self.children, self.leaves, self.saved = n, least, children, leaves, saved
        self.ends, self.pieces, self.rows = list(ends), pieces, list(rows)

    def add(self, other: _Top) -> None:
        """``other`` is the same node, seen by members that come later in the order."""
        self.n += other.n
        if self.least is None or (other.least is not None and other.least < self.least):
            self.least = other.least
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.pieces = self.pieces or other.pieces
        self.ends.extend(other.ends)
        self.rows.extend(other.rows)


class Path:
    """One conversation's way from the root: turn keys, turn sizes, and what hangs on it by depth."""

    def __init__(self, keys: bytes, sizes: list[int], tops: dict[int, _Top]):
        self.keys, self.sizes, self.tops = keys, sizes, tops
        self._ids: list[bytes] = [bytes(_KEY)]

    def id(self, depth: int) -> bytes:
        """The hash of the first ``depth`` turns."""
        while len(self._ids) <= depth:
            at = _KEY * (len(self._ids) - 1)
            self._ids.append(hashlib.blake2b(self._ids[-1] + self.keys[at : at + _KEY], digest_size=_KEY).digest())
        return self._ids[depth]


def common(a: bytes, b: bytes) -> int:
    """The number of leading turns that two key sequences share."""
    n = min(len(a), len(b)) // _KEY * _KEY
    if a[:n] == b[:n]:
        return n // _KEY
    differ = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(differ.argmax()) // _KEY


def merge(paths: list[Path], part: int, last: bool, named: bool) -> list[dict]:
    """Rows of all nodes that ``paths``, in order, close, and the contracted rest as rows of paths.
    ``last``: nothing else exists, so every node is closed.  ``named``: rows get their prefix hash."""
    rows: list[dict] = []
    n = len(paths)
    edges = [common(paths[i].keys, paths[i + 1].keys) for i in range(n - 1)]
    up = list(range(n))
    left, right = list(range(n)), list(range(n))
    depth = [len(p.sizes) for p in paths]
    hung = [p.tops for p in paths]
    top = [h.pop(d, None) or _Top() for h, d in zip(hung, depth)]
    kept: dict[tuple[int, int], _Top] = {}

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def lower(r: int, to: int) -> None:
        open_ = not last and (left[r] == 0 or right[r] == n - 1)
        path = paths[0 if left[r] == 0 else n - 1 if open_ else left[r]]
        while depth[r] > to:
            d, t = depth[r], top[r]
            if open_:
                if t.ends:
                    rows.append({"kind": _PIECE, "conv_id": t.ends[0], "id": path.id(d), "ends": ",".join(map(str, t.ends))})
                    t.ends, t.pieces = [], True
                for row in t.rows:
                    row["pid"] = path.id(d)
                t.rows = []
                kept[0 if left[r] == 0 else 1, d] = t
                above = _Top()
            else:
                saved, leaves = t.saved + (t.n - 1) * (path.sizes[d - 1] if d else 0), t.leaves if t.children else 1
                row = {"kind": _NODE, "conv_id": t.least, "depth": d, "n_convs": t.n, "n_children": t.children, "n_leaves": leaves, "saved": saved, "pieces": t.pieces}
                if named:
                    row["id"] = path.id(d)
                if not t.pieces:
                    row["ends"] = hashlib.sha256(",".join(map(str, t.ends)).encode()).hexdigest() if t.ends else _NONE
                rows.append(row)
                for child in t.rows:
                    child["parent_conv_id"] = t.least
                above = _Top(t.n, t.least, 1, leaves, saved, rows=[row])
            depth[r] = d - 1
            if d - 1 in hung[r]:
                above.add(hung[r].pop(d - 1))
            top[r] = above

    for i in sorted(range(n - 1), key=lambda i: -edges[i]):  # stable: from left to right within a depth
        a, b = find(i), find(i + 1)
        lower(a, edges[i])
        lower(b, edges[i])
        top[a].add(top[b])
        for d, t in hung[b].items():
            hung[a][d].add(t) if d in hung[a] else hung[a].update({d: t})
        up[b], right[a], top[b] = a, right[b], None
    lower(find(0), -1)
    if not last:
        for side, path in ((0, paths[0]), (1, paths[-1]))[: 1 if n == 1 else 2]:
            for d in range(len(path.sizes) + 1):
                t = kept.get((side, d)) or _Top()
                rows.append({"kind": _PATH, "part": part, "side": side, "depth": d, "key": path.keys[_KEY * (d - 1) : _KEY * d] if d else b"", "size": path.sizes[d - 1] if d else 0,
                             "conv_id": t.least, "n_convs": t.n, "n_children": t.children, "n_leaves": t.leaves, "saved": t.saved, "pieces": t.pieces})
    return rows


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, key, sizes) of a partition, block by block."""
    part, held, turns = TaskContext.get().partitionId() << 20, [], 0
    for batch in batches:
        for conv, key, sizes in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(Path(key, sizes, {len(sizes): _Top(1, conv, ends=[conv])}))
            turns += 1 + len(sizes)
            if turns >= TURNS:
                yield from pa.Table.from_pylist(merge(held, part, False, False), _SCHEMA).to_batches(10_000)
                part, held, turns = part + 1, [], 0
    if held:
        yield from pa.Table.from_pylist(merge(held, part, False, False), _SCHEMA).to_batches(10_000)


def _contracted(last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        for group, own in groupby(rows, key=lambda r: r["group"]):
            paths = []
            for _, nodes in groupby(own, key=lambda r: (r["part"], r["side"])):
                nodes = list(nodes)
                tops = {r["depth"]: _Top(r["n_convs"], r["conv_id"], r["n_children"], r["n_leaves"], r["saved"], pieces=r["pieces"]) for r in nodes}
                paths.append(Path(b"".join(r["key"] for r in nodes), [r["size"] for r in nodes[1:]], tops))
            yield from pa.Table.from_pylist(merge(paths, group, last, True), _SCHEMA).to_batches(10_000)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, ends): the SHA-256 of each id's pieces, which come in order; one piece is held at a time."""
    now, state = None, None
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            key = key.as_py()
            if key != now:
                if now is not None:
                    yield pa.RecordBatch.from_pydict({"id": [now], "ends": [state.hexdigest()]})
                now, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_py().encode())
    if now is not None:
        yield pa.RecordBatch.from_pydict({"id": [now], "ends": [state.hexdigest()]})


def trie(sequences_: DataFrame, turns: int = TURNS, fan: int = FAN) -> DataFrame:
    """One row for every distinct prefix of (conv_id, key, sizes), as ``rebuilt`` gives them: (conv_id: the
    smallest member, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    spark = sequences_.sparkSession
    size = sequences_.agg(F.coalesce(F.sum(1 + F.size("sizes")), F.lit(0)), F.count("*")).first()
    parts = max(-(-size[0] // turns), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size[1] // 1000)), 1)
    ordered = sequences_.select("conv_id", "key", "sizes").repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    levels = [keep(ordered.mapInArrow(_blocks, _DDL), "forest")]
    width, left = 1 << 20, parts  # the first merge brings a partition's blocks together, too
    while left:
        last = left <= fan
        group = F.floor(F.col("part") / (width * fan)).cast("long")
        paths = levels[-1].where(F.col("kind") == _PATH).withColumn("group", F.lit(0).cast("long") if last else group)
        dealt = paths.repartition(1 if last else -(-left // fan), "group").sortWithinPartitions("group", "part", "side", "depth")
        levels.append(keep(dealt.mapInArrow(_contracted(last), _DDL), "forest"))
        width, left = 1, 0 if last else -(-left // fan)

    every = reduce(DataFrame.unionByName, levels)
    nodes = every.where(F.col("kind") == _NODE)
    opened = keep(nodes.where("id is not null").select(F.col("id").alias("pid"), F.col("conv_id").alias("least"), "n_children"), "opened")
    resolved = join_hot(nodes.where("pid is not null"), opened, "pid", "n_children")
    nodes = nodes.where("pid is null").unionByName(resolved.withColumn("parent_conv_id", F.col("least")).drop("least"))
    pieces = every.where(F.col("kind") == _PIECE).select("id", "ends", "conv_id").repartition("id").sortWithinPartitions("id", "conv_id")
    ends = keep(pieces.select("id", "ends").mapInArrow(_hashed, "id binary, ends string"), "ends").withColumnRenamed("ends", "whole")
    given = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens")]
    whole = nodes.where("not pieces").select(*given, F.col("ends").alias("ends_sha256"))
    return whole.unionByName(nodes.where("pieces").join(ends, "id").select(*given, F.col("whole").alias("ends_sha256")))
