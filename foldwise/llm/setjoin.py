"""Size-aware heavy-light similarity join of word-shingle sets, and its components.

A document's set is its distinct shingles (64-bit hashes).  Equal sets form a class; classes are joined,
not documents.  All sets sort their shingles alike: rare before common, by a table of common shingles that
holds at most ``COMMON`` entries, then by hash.  With Jaccard index t, a partner shares at least
``ceil(t n)`` shingles of a set of n, so the first ``n - ceil(t n) + c`` shingles of both share c:

* light sets, smaller than a boundary, list every 2-subset of that prefix (c = 2) as keys;
* heavy sets list single shingles (c = 1), whose inverted lists are scanned.

Sets from t times the boundary on do both, so every pair meets in one way or the other.  The boundary is
the one with the least cost, counted from the sizes of all sets and the measured length of the lists.

A list isn't expanded into pairs.  Its hub is the member with the largest share of common shingles (of near
copies, one close to their origin).  First each class is checked with the hub it shares most lists with,
and components are made.  Then the classes of one hub are compared with one another where they lie in
different components, block by block (a block has a bounded number of shingles, and each pair of blocks is
a task's matter), giving out links only.  Last come pairs of one list under different hubs in different
components: by a bound on the overlap from counts of ``SKETCH`` hash ranges, and if it allows a link,
exactly.  So every pair that shares a list is decided or lies in one component already.

Null, empty and blank texts have an empty set and link with nothing; texts with fewer words than a
shingle are one shingle; repeated rows are equal sets; extra columns are not looked at.  Two different
shingles or sets with one 64-bit hash would count as equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.components import components
from foldwise.llm.hashing import _LANE, chunks, distinct_sets, mix, shingles, words
from foldwise.llm.tables import BROADCAST_ROWS, discard, keep, semi, settings

#: Jaccard index in percent; words in a shingle; the most common shingles that are told apart.
PERCENT, WORDS, COMMON = 75, 5, 1 << 18
BOUNDARIES = (0, 8, 16, 24, 32, 48, 64)
SKETCH = 64
#: Shingles of a block of classes that are compared with one another, columns of one product, and sets of its sides.
BLOCK, COLUMNS, SIDES = 1 << 18, 4096, (512, 2048)
#: Shingles a task counts before it lets go of those met once.
COUNTED = 1 << 20
#: Rows that a Python worker gets at once, and short rows that it gives at once.
ROWS, GIVEN = 500, 1 << 16
#: Parts in which pairs are checked and hubs compared, one after another, so that the sets of one part are on their way at a time.
PARTS = 4
#: Bytes of texts or sets that a Python worker works on at once; its arrays take some fifty times that.
CHUNK = 1 << 19


def sets(part_raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a chunk's texts, their offsets, and each set's class (0: empty)."""
    n = len(offsets) - 1
    runs, at = distinct_sets(*shingles(*words(part_raw, offsets), n, k), n)
    classes = np.zeros(n, np.int64)
    for i in np.flatnonzero(np.diff(at)):
        classes[i] = int.from_bytes(hashlib.blake2b(runs[at[i] : at[i + 1]].tobytes(), digest_size=8).digest(), "little", signed=True) or 1
    return runs, at, classes


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of ``GIVEN`` rows, since the JVM holds a piece outside its heap."""
    yield from (batch.slice(at, GIVEN) for at in range(0, batch.num_rows, GIVEN))


def need(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The fewest shingles that a set of n shares with a partner."""
    return -(-n * percent // 100)


def measure(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """The one pass over all texts: rows (key, class, n, set) of the documents, the set for the first of its class in
    a task, and rows (shingle, df) of shingles that a task met more than once."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def common() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            found, n = found[n > 1].view(np.int64), n[n > 1]
            return pa.RecordBatch.from_arrays([pa.nulls(len(n), types[0]), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary()), pa.array(found), pa.array(n)], names)

        types, names = [None], [key, "class", "n", "set", "shingle", "df"]
        for batch in batches:
            types[0] = batch.schema.field(0).type
            for part, raw, offsets in chunks(batch, text, CHUNK):
                runs, at, classes = sets(raw, offsets, k)
                n = np.diff(at)
                new = n > 0
                for i, c in enumerate(classes.tolist()):
                    new[i] &= c not in seen
                    seen.add(c)
                whole = pa.array([runs[x:y].tobytes() if w else None for x, y, w in zip(at, at[1:], new)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(classes, mask=n == 0), pa.array(n), whole, pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64())], names)
                kept = runs[np.repeat(new, n)]
                held.append(kept)
                size += len(kept)
                if size > COUNTED:
                    yield from sliced(common())
                    held, size = [], 0
        if held:
            yield from sliced(common())

    schema = f"`{key}` {kind.simpleString()}, class long, n long, set binary, shingle long, df long"
    return docs.select(key, text).mapInArrow(run, schema)


def set_chunks(batch: pa.RecordBatch, limit: int = CHUNK) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Slices of (class, set) of about ``limit`` bytes: (classes, shingles of all sets, offsets of the sets)."""
    column = batch.column(1).cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    low = 0
    while low < len(column):
        high = min(len(column), max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1))
        raw = np.frombuffer(data, np.uint8, offsets[high] - offsets[low], offsets[low]).view(np.uint64)
        yield batch.column(0).slice(low, high - low), raw, (offsets[low : high + 1] - offsets[low]) // 8
        low = high


def boundary(sizes: dict[int, int], scanned: float, percent: int = PERCENT) -> int:
    """The size from which sets are heavy.  Cost of a light set: its 2-subsets; of a set from ``percent``
    of the boundary on: its single shingles, each with ``scanned`` entries of its list."""
    n = np.array(sorted(sizes), np.int64)
    count = np.array([sizes[int(i)] for i in n], np.float64)
    p1 = n - need(n, percent) + 1
    p2 = np.minimum(p1 + 1, n)
    cost = [float((count * p2 * (p2 - 1) / 2)[n < b].sum() + (count * p1 * (1 + scanned))[100 * n >= percent * b].sum()) for b in BOUNDARIES]
    return BOUNDARIES[int(np.argmin(cost))]


def listed(runs: np.ndarray, at: np.ndarray, common: np.ndarray, df: np.ndarray, heavy_from: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, set number) of all lists that the sets of a chunk belong to, and the share of common
    shingles of each set in thousandths."""
    size = np.diff(at)
    owner = np.repeat(np.arange(len(size)), size)
    rank = np.zeros(len(runs), np.int64)
    if len(common):
        spot = np.minimum(np.searchsorted(common, runs), len(common) - 1)
        rank = np.where(common[spot] == runs, df[spot], 0)
    order = np.lexsort((runs, rank, owner))
    ordered = runs[order]
    place = np.arange(len(runs)) - np.repeat(at[:-1], size)
    p1 = size - need(size, percent) + 1
    heavy = np.repeat((100 * size >= percent * heavy_from) & (size > 0), size) & (place < np.repeat(p1, size))
    keys, which = [mix(ordered[heavy] ^ _LANE[9])], [owner[heavy]]
    light = (size < heavy_from) & (size > 1)
    p2 = np.minimum(p1 + 1, size)
    for j in range(1, int(p2[light].max()) if light.any() else 0):
        docs = np.flatnonzero(light & (p2 > j))
        second = ordered[at[docs] + j] * _LANE[1]
        for i in range(j):
            keys.append(mix(ordered[at[docs] + i] * _LANE[0] + second))
            which.append(docs)
    mid = 1000 * np.bincount(owner, rank > 0, len(size)) // np.maximum(size, 1)
    return np.concatenate(keys).view(np.int64), np.concatenate(which), mid.astype(np.int64)


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(``key``, n, class, component): for every row the size of its set, its class (null: empty) and the
    smallest ``key`` that links reach from it, itself included."""
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(ROWS)):  # texts and sets are long rows
        return _joined(docs.select(key, text), key, text, k, percent)


def _joined(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    measured = keep(measure(docs, key, text, k), "sets")
    rows = measured.where("n is not null").select(key, "class", "n")
    held = measured.where("set is not null")  # a class may be held by several tasks
    once = rows.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).isEmpty()  # every row has a key of its own
    classes = keep(rows.where("class is not null").groupBy("class", "n").agg(F.min(key).alias("first"), F.count("*").alias("rows")), "classes")
    holders = held.groupBy("class").agg(F.min(key).alias(key))

    # the common shingles: the power of two is the least whose table fits
    tallied = keep(measured.where("shingle is not null").groupBy("shingle").agg(F.sum("df").alias("df")), "common")
    levels = dict(tallied.groupBy(F.floor(F.log2("df")).cast("int").alias("l")).count().collect())
    least, total = 62, 0
    while least > 1 and total + levels.get(least - 1, 0) <= COMMON:
        least -= 1
        total += levels.get(least, 0)
    table = tallied.where(F.col("df") >= 2**least).select("shingle", "df").toArrow() if total else None  # at most COMMON rows
    common, df = (table["shingle"].to_numpy().view(np.uint64), table["df"].to_numpy()) if table is not None else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(common)
    common, df = common[order].copy(), df[order].copy()

    # a list of a rare shingle is as long as shingles below the table's threshold are common
    rare = tallied.where(F.col("df") < 2**least).agg(F.sum(F.col("df") * F.col("df")), F.sum("df")).first()
    shingled = classes.agg(F.sum("n")).first()[0] or 0
    scanned = ((rare[0] or 0) + max(0, shingled - (rare[1] or 0))) / max(1, shingled)
    sizes = {int(n): c for n, c in classes.groupBy(F.least("n", F.lit(4 * BOUNDARIES[-1])).alias("n")).count().collect()}
    heavy_from = boundary(sizes, scanned, percent)

    def posted(full: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for own, runs, at in set_chunks(batch):
                    keys, which, mid = listed(runs, at, common, df, heavy_from, percent)
                    if not full:
                        yield from sliced(pa.RecordBatch.from_arrays([pa.array(keys)], ["key"]))
                    else:
                        yield from sliced(pa.RecordBatch.from_arrays([pa.array(keys), own.take(pa.array(which)), pa.array(np.diff(at)[which]), pa.array(mid[which])], ["key", "class", "n", "mid"]))

        return held.select("class", "set").mapInArrow(run, "key long, class long, n long, mid long" if full else "key long")

    shared = keep(posted(False).groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key"), "keys")
    n = shared.count()
    lists = posted(True).join(F.broadcast(shared) if n <= BROADCAST_ROWS else shared, "key").distinct()
    lists = keep(lists, "lists")
    discard(shared)
    hubs = lists.groupBy("key").agg(F.max(F.struct("mid", "class")).alias("h"), F.count("*").alias("m")).where("m > 1")
    votes = lists.join(hubs.select("key", F.col("h.mid").alias("h_mid"), F.col("h.class").alias("hub")), "key").where("class <> hub")
    votes = votes.groupBy("class", "n", "hub").agg(F.count("*").alias("c"), F.max("h_mid").alias("h_mid"))
    best = votes.groupBy("class", "n").agg(F.max(F.struct("c", "h_mid", "hub")).alias("b"))
    best = keep(best.select("class", "n", F.col("b.hub").alias("hub")), "hubs")
    kept = [lists, best]
    full = _whole_sets(held, holders, best.select("class").union(best.select("hub")).distinct(), key, once)
    links = _checked(best.select(F.col("class").alias("a"), F.col("hub").alias("b")), full, percent)
    groups = keep(components(links, "a", "b").select(F.col("node").alias("class"), "component"), "groups")
    links = _within_hubs(best, groups, full, percent)
    groups = _with(groups, links)

    # the rest: pairs of one list in different components and under different hubs
    apart = lists.drop("mid").join(groups, "class", "left").withColumn("component", F.coalesce("component", "class")).join(best.select("class", "hub"), "class", "left")
    several = apart.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    apart = keep(apart.join(several, "key", "left_semi"), "apart")
    bare, apart = apart, keep(apart.join(_sketches(_whole_sets(held, holders, apart.select("class").distinct(), key, once)), "class"), "apart")
    discard(bare, *kept)
    left, right = (apart.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("class", "n", "component", "hub", "sketch"))) for s in "ab")
    most = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    done = F.coalesce((F.col("hub_a") == F.col("hub_b")) | (F.col("hub_a") == F.col("class_b")) | (F.col("hub_b") == F.col("class_a")), F.lit(False))
    may = ~done & (F.col("class_a") < F.col("class_b")) & (F.col("component_a") != F.col("component_b")) & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    rest = left.join(right, "key").where(may & (most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent))
    rest = keep(rest.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct(), "pairs")
    discard(apart)
    wanted = rest.select(F.col("a").alias("class")).union(rest.select("b")).distinct()
    if not rest.isEmpty():
        groups = _with(groups, _checked(rest, _whole_sets(held, holders, wanted, key, once), percent))
    groups = groups.withColumnRenamed("component", "group")

    firsts = classes.join(groups, "class", "left").withColumn("group", F.coalesce("group", "class"))
    low = firsts.groupBy("group").agg(F.min("first").alias("component"), F.sum("rows").alias("rows")).where("rows > 1").select("group", "component")
    of = keep(firsts.join(low, "group").select("class", "component"), "components")
    out = rows.join(F.broadcast(of) if of.count() <= BROADCAST_ROWS else of, "class", "left")
    return out.select(key, "n", "class", F.coalesce("component", key).alias("component"))


def _with(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Components (class, component) under further links: a component goes in as one link for each class."""
    if links.isEmpty():
        return groups
    links = groups.select(F.col("class").alias("a"), F.col("component").alias("b")).unionByName(links)
    return components(links, "a", "b").select(F.col("node").alias("class"), "component")


def _sketches(whole: DataFrame) -> DataFrame:
    """(class, sketch): counts of a set's shingles in ``SKETCH`` hash ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, runs, at in set_chunks(batch):
                doc = np.repeat(np.arange(len(own)), np.diff(at))
                table = np.bincount(doc * SKETCH + (runs >> np.uint64(58)).astype(np.int64), minlength=len(own) * SKETCH).reshape(-1, SKETCH)
                yield pa.RecordBatch.from_arrays([own, pa.array(list(table.astype(np.int32)), pa.list_(pa.int32()))], ["class", "sketch"])

    return whole.mapInArrow(run, "class long, sketch array<int>")


def _whole_sets(held: DataFrame, holders: DataFrame, wanted: DataFrame, key: str, once: bool) -> DataFrame:
    """(class, set) of the wanted classes, one row each: that of the holder, the smallest key of those that hold the
    class.  ``once``: every key has one row, so there is one such row."""
    ids = keep(holders.join(wanted, "class", "left_semi").where(F.col(key).isNotNull()), "wanted") if once else keep(wanted, "wanted")
    out = semi(held, ids, ["class", key] if once else ["class"], ids.count()).select("class", "set")
    return out if once else keep(out.dropDuplicates(["class"]), "full")  # else they are read from where they are held


def _sent(part: DataFrame, full: DataFrame, on: str) -> DataFrame:
    """``part`` with the sets of ``full``, which stay where they are read if ``part`` is small."""
    n = part.count()
    return full.join(F.broadcast(part), on) if n <= BROADCAST_ROWS // 4 else part.join(semi(full, part.select(on).distinct(), [on], n), on)


def _checked(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar, exactly."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                spot = np.searchsorted(x, y)
                both = int((x[np.minimum(spot, len(x) - 1)] == y).sum())
                same.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(same, pa.bool_()))

    found = []
    for i in range(PARTS):
        part = pairs.select("a", "b").where(F.pmod(F.xxhash64("b"), F.lit(PARTS)) == i)
        ids = part.select(F.col("b").alias("class")).distinct()
        right = semi(full, ids, ["class"], ids.count()).select(F.col("class").alias("b"), F.col("set").alias("y"))
        both = _sent(part, full.select(F.col("class").alias("a"), F.col("set").alias("x")), "a").join(right, "b")
        found.append(keep(both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "similar"))
    return reduce(DataFrame.unionByName, found)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set: products of incidence matrices over
    the shingles that both sides hold, some columns at a time."""
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    rows = [np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (left, right)]
    columns = [np.searchsorted(shared, x) for x in (a, b)]
    hit = [np.append(shared, 0)[c] == x if len(shared) else np.zeros(len(x), bool) for c, x in zip(columns, (a, b))]
    for at in range(0, len(shared), COLUMNS):
        part = []
        for r, c, h, n in zip(rows, columns, hit, out.shape):
            take = h & (c >= at) & (c < at + COLUMNS)
            m = np.zeros((n, min(COLUMNS, len(shared) - at)), np.float32)
            m[r[take], c[take] - at] = 1
            part.append(m)
        out += part[0] @ part[1].T
    return out


def _within_hubs(best: DataFrame, groups: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of one hub that lie in different components.  Kept."""
    of = groups.withColumnRenamed("component", "own")
    members = best.join(of, "class", "left").withColumn("own", F.coalesce("own", "class"))
    # what a hub's component holds needs no look; a hub is busy if some class of it lies outside
    hubs = members.groupBy("hub").agg(F.sum("n").alias("shingles"), F.min("own").alias("x"), F.max("own").alias("y")).where("x <> y")
    hubs = hubs.select("hub", F.ceil(F.col("shingles") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    dealt = members.join(hubs, "hub").withColumn("own_block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = keep(dealt.select("hub", F.least("own_block", "other").alias("i"), F.greatest("own_block", "other").alias("j"), "own_block", "class", "own"), "dealt")
    parts = int(best.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(group: list[tuple]) -> pa.RecordBatch:
        sides = [[r for r in group if r[3] == group[0][s]] for s in (1, 2)]
        values = [[np.frombuffer(r[6], np.uint64) for r in side] for side in sides]
        if not (sides[0] and sides[1]):
            return pa.RecordBatch.from_pydict({"a": [], "b": []}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        size = [np.array([len(v) for v in x]) for x in values]
        name, own_ = ([np.array([r[c] for r in side]) for side in sides] for c in (4, 5))
        ok = np.zeros((len(sides[0]), len(sides[1])), bool)
        for at in range(0, len(sides[0]), SIDES[0]):
            for to in range(0, len(sides[1]), SIDES[1]):
                x, y = slice(at, at + SIDES[0]), slice(to, to + SIDES[1])
                both = overlaps(values[0][x], values[1][y])
                ok[x, y] = 100 * both >= percent * (size[0][x, None] + size[1][y] - both)
        x, y = np.nonzero(ok & (own_[0][:, None] != own_[1]))
        return pa.RecordBatch.from_arrays([pa.array(name[0][x]), pa.array(name[1][y])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][:3] != row[:3]:
                    yield compare(group)
                    group = []
                group.append(row)
        if group:
            yield compare(group)

    found = []
    for i in range(PARTS):
        part = _sent(dealt.where(F.pmod(F.xxhash64("hub", "i", "j"), F.lit(PARTS)) == i), full, "class")
        part = part.select("hub", "i", "j", "own_block", "class", "own", "set").repartition(parts, "hub", "i", "j").sortWithinPartitions("hub", "i", "j")
        found.append(keep(part.mapInArrow(run, "a long, b long"), "links"))
    discard(dealt)
    return reduce(DataFrame.unionByName, found)
