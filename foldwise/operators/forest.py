"""Permutation importance of a random forest without a row for every copy of a row.

A feature matters to a forest only by which of its thresholds it exceeds, so a row is a code: a bin for every
feature. For each tree a bin has a mask of the leaves that it leaves open; the leaf of a row is the first that all of
its bins leave open (Lucchese et al., QuickScorer). A copy with one feature from another row then costs one AND a tree,
and none where the bin stays the same. Scores are sums in the order of the trees, as Spark's are, to the last bit.

The AUC of all copies is exact: scores are dealt, as arrays, to ranges; within a range the pairs are counted after
sorting, and pairs of different ranges follow from the ranges' counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Leaves of a tree that fit its mask, rows scored at a time, and rows whose scores lie in one range.
LEAVES, CHUNK, RANGE_ROWS = 64, 2048, 50_000


class Forest(NamedTuple):
    """``cuts``: the thresholds of each feature; ``masks``: (trees, bins) of each feature; ``votes``: (trees, leaves) of
    each class."""
    cuts: list[np.ndarray]
    masks: list[np.ndarray]
    votes: list[np.ndarray]


def tables(model, n_features: int) -> Forest | None:
    """The tables of a fitted binary forest; null if it isn't one, splits on sets of categories or has larger trees."""
    java = getattr(model, "_java_obj", None)
    if java is None or not java.getClass().getSimpleName() == "RandomForestClassificationModel" or model.numClasses != 2:
        return None
    splits, leaves = [], []  # (tree, feature, threshold, first leaf, leaf after the last) of the left side

    def walk(node, tree: int) -> None:
        if node.getClass().getSimpleName() == "LeafNode":
            leaves[tree].append(list(node.impurityStats().stats()))
            return
        split, first = node.split(), len(leaves[tree])
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError
        walk(node.leftChild(), tree)
        splits.append((tree, split.featureIndex(), split.threshold(), first, len(leaves[tree])))
        walk(node.rightChild(), tree)

    trees = list(java.trees())
    try:
        for t, tree in enumerate(trees):
            leaves.append([])
            walk(tree.rootNode(), t)
    except ValueError:
        return None
    if max(map(len, leaves)) > LEAVES:
        return None
    cuts = [np.array(sorted({s[2] for s in splits if s[1] == f})) for f in range(n_features)]
    masks = [np.full((len(trees), len(c) + 1), np.uint64(2**64 - 1)) for c in cuts]
    for t, f, threshold, first, end in splits:  # a value beyond the threshold closes the left side
        masks[f][t, np.searchsorted(cuts[f], threshold) + 1 :] &= np.uint64(2**64 - 1) ^ np.uint64((1 << end) - (1 << first))
    votes = [np.zeros((len(trees), LEAVES)) for _ in range(2)]
    for t, own in enumerate(leaves):
        for at, stats in enumerate(own):
            total = sum(stats)
            for c in range(2):
                votes[c][t, at] = stats[c] / total if total else 0.0
    return Forest(cuts, masks, votes)


def codes(forest: Forest, x: Sequence[np.ndarray]) -> np.ndarray:
    """(rows, features): the bins of the features' values; a missing value exceeds every threshold."""
    return np.stack([np.searchsorted(cuts, v, "left") for cuts, v in zip(forest.cuts, x)], axis=1).astype(np.uint16)


def chance(forest: Forest, open_: np.ndarray) -> np.ndarray:
    """P(class 1) of rows with (trees, rows) masks of open leaves."""
    low = open_ & (~open_ + np.uint64(1))
    leaf = (np.frexp(low.astype(np.float64))[1] - 1).astype(np.intp)  # a power of two is exact
    votes = [np.zeros(open_.shape[1]) for _ in range(2)]
    for t in range(len(open_)):
        for c in range(2):
            votes[c] += forest.votes[c][t].take(leaf[t])
    total = votes[0] + votes[1]
    return np.where(total != 0, votes[1] / np.where(total != 0, total, 1.0), votes[1])


def copies(forest: Forest, own: np.ndarray, other: np.ndarray, wanted: Sequence[int]) -> Iterator[np.ndarray]:
    """The scores of the rows (codes ``own``), then those with each of the ``wanted`` features taken from ``other``."""
    n = len(own)
    masks = [m.take(own[:, f], axis=1) for f, m in enumerate(forest.masks)]
    after = [None] * (len(masks) + 1)  # what the features from the f-th on leave open
    after[-1] = np.full((len(forest.votes[0]), n), np.uint64(2**64 - 1))
    for f in range(len(masks) - 1, -1, -1):
        after[f] = after[f + 1] & masks[f]
    base = chance(forest, after[0])
    yield base
    before, found = after[-1], {}
    for f, mask in enumerate(masks):
        if f in wanted:
            scores, moved = base, np.flatnonzero(own[:, f] != other[:, f])
            if len(moved):
                rest = before[:, moved] & after[f + 1][:, moved]
                scores = base.copy()
                scores[moved] = chance(forest, rest & forest.masks[f].take(other[moved, f], axis=1))
            found[f] = scores
        before = before & mask
    for f in wanted:
        yield found[f]


def coded(rows: DataFrame, forest: Forest, cols: Sequence[str], label: str) -> DataFrame:
    """(id, label, code) of ``rows``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = [batch.column(c).fill_null(math.nan).to_numpy(zero_copy_only=False) for c in cols]
                own = np.ascontiguousarray(codes(forest, x))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in own], pa.binary())], ["id", "label", "code"])

    picked = rows.select("id", F.col(label).cast("int").alias("label"), *(F.col(c).cast("double").alias(c) for c in cols))
    return picked.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, label int, code binary")


def paired_auc(pairs: DataFrame, forest: Forest, wanted: Sequence[int], rows: DataFrame, n: int) -> DataFrame:
    """(what, rep, auc): of ``pairs`` (rep, label, own, other: codes) of the ``n`` coded ``rows`` the AUC of the rows
    (what: -1) and of their copies with a ``wanted`` feature (what: its place there) taken from the other row. Null with
    one class."""
    width, ranges = len(forest.cuts), max(1, math.ceil(n / RANGE_ROWS))
    bounds = np.empty(0)
    if ranges > 1:  # of a few thousand rows: any bounds are right, these deal the scores evenly
        some = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < max(1, int((1 << 20) * min(1.0, 20_000 / n)))).select("code").limit(100_000).collect()
        if some:
            own = np.frombuffer(b"".join(r[0] for r in some), np.uint16).reshape(-1, width)
            scores = np.concatenate([next(copies(forest, own[a : a + CHUNK], own[a : a + CHUNK], [])) for a in range(0, len(own), CHUNK)])
            bounds = np.unique(np.quantile(scores, np.arange(1, ranges) / ranges, method="nearest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, labels = batch.column("rep").to_numpy(), batch.column("label").fill_null(-1).to_numpy(zero_copy_only=False)
            own, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, width) for c in ("own", "other"))
            for rep in np.unique(reps):
                at = np.flatnonzero((reps == rep) & (labels >= 0) & (labels <= 1))
                made: list[list[np.ndarray]] = [[] for _ in range(len(wanted) + 1)]
                for a in range(0, len(at), CHUNK):
                    part = at[a : a + CHUNK]
                    for to, scores in zip(made, copies(forest, own[part], other[part], wanted)):
                        to.append(scores)
                out: dict[str, list] = {c: [] for c in ("rep", "what", "range", "pos", "neg")}
                for what, parts in enumerate(made, -1):
                    if not parts:
                        continue
                    scores = np.concatenate(parts)
                    place = np.searchsorted(bounds, scores, "right")
                    order = np.argsort(place, kind="stable")
                    y, scores, ends = labels[at][order] == 1, scores[order], np.searchsorted(place[order], np.arange(len(bounds) + 2))
                    for r in range(len(bounds) + 1):
                        y_, s_ = y[ends[r] : ends[r + 1]], scores[ends[r] : ends[r + 1]]
                        if len(s_):
                            for c, v in zip(out, (int(rep), what, r, s_[y_].tobytes(), s_[~y_].tobytes())):
                                out[c].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out["rep"], pa.int32()), pa.array(out["what"], pa.int32()), pa.array(out["range"], pa.int32()),
                                                  pa.array(out["pos"], pa.binary()), pa.array(out["neg"], pa.binary())], list(out))

    def count(group: pa.Table) -> pa.Table:
        pos, neg = (np.sort(np.frombuffer(b"".join(group.column(c).to_pylist()))) for c in ("pos", "neg"))
        below, upto = (np.searchsorted(neg, pos, side).astype(np.float64).sum() for side in ("left", "right"))
        keys = {c: group.column(c)[:1] for c in ("rep", "what", "range")}
        return pa.table({**keys, "p": [float(len(pos))], "n": [float(len(neg))], "u": [0.5 * (below + upto)]})

    dealt = pairs.mapInArrow(run, "rep int, what int, range int, pos binary, neg binary")
    parts = dealt.groupBy("rep", "what", "range").applyInArrow(count, "rep int, what int, range int, p double, n double, u double")
    lower = F.coalesce(F.sum("n").over(Window.partitionBy("rep", "what").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    parts = parts.withColumn("u", F.col("u") + F.col("p") * lower)
    return parts.groupBy("what", "rep").agg(F.try_divide(F.sum("u"), F.sum("p") * F.sum("n")).alias("auc"))
