"""The set join sends sets to pairs and to hubs in parts, with the same results."""

import numpy as np
import pyarrow as pa

from foldwise.llm import setjoin
from foldwise.llm.tables import keep


def test_sets_are_sent_to_hubs_in_parts(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 2**62, 40).astype(np.uint64)
    sets = {i: np.sort(np.concatenate([base[: 40 - i % 12], rnd.integers(0, 2**62, i % 12).astype(np.uint64)])) for i in range(60)}
    full = keep(spark.createDataFrame([(i, v.tobytes()) for i, v in sets.items()], "class long, set binary"), "full")
    best = keep(spark.createDataFrame([(i, 40, i % 5) for i in sets if i >= 5], "class long, n long, hub long"), "best")
    groups = spark.createDataFrame([], "class long, component long")

    def alike(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both)

    wanted = {(a, b) for a in range(5, 60) for b in range(5, 60) if a < b and a % 5 == b % 5 and alike(a, b)}
    assert wanted
    for limit in (setjoin.BROADCAST_ROWS, 0):
        monkeypatch.setattr(setjoin, "BROADCAST_ROWS", limit)
        seen = []
        monkeypatch.setattr(setjoin, "keep", lambda df, what: seen.append(what) or keep(df, what))
        found = setjoin._within_hubs(best, groups, full, 75)
        assert {(min(r.a, r.b), max(r.a, r.b)) for r in found.collect()} == wanted
        assert seen.count("links") == setjoin.PARTS
        pairs = spark.createDataFrame([(a, b) for a in range(12) for b in range(12) if a < b], "a long, b long")
        assert {(r.a, r.b) for r in setjoin._checked(pairs, full, 75).collect()} == {(a, b) for a in range(12) for b in range(12) if a < b and alike(a, b)}


def test_python_workers_give_and_compare_little_at_once(spark, monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(range(200_000))], ["key"])
    parts = list(setjoin.sliced(batch))
    assert [p.num_rows for p in parts] == [1 << 16, 1 << 16, 1 << 16, 200_000 - 3 * (1 << 16)] and pa.Table.from_batches(parts) == pa.Table.from_batches([batch])
    assert list(setjoin.sliced(batch.slice(0, 0))) == []
    # a cloud of small sets, compared in slices: none is left out
    monkeypatch.setattr(setjoin, "SIDES", (7, 5))
    given = [tuple(np.arange(i % 9, i % 9 + 12, dtype=np.uint64)) for i in range(40)]

    rows = spark.createDataFrame([(i, np.array(v, np.uint64).tobytes()) for i, v in enumerate(given)], "class long, set binary")
    best = keep(spark.createDataFrame([(i, 12, 99) for i in range(40)], "class long, n long, hub long"), "best")
    found = setjoin._within_hubs(best, spark.createDataFrame([], "class long, component long"), keep(rows, "full"), 75)
    alike = {(i, j) for i in range(40) for j in range(i) if 100 * len({*given[i]} & {*given[j]}) >= 75 * len({*given[i]} | {*given[j]})}
    assert {(max(r.a, r.b), min(r.a, r.b)) for r in found.collect()} == alike
