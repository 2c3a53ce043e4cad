"""Isotonic regression by ranges against the sequential fit."""

import random

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from foldwise.operators import models as M
from foldwise.operators.isotonic import apply_isotonic, fit_isotonic, pool


def sequential(rows):
    """Score → fitted value, by repeated passes over all points."""
    points = {}
    for x, y in rows:
        s, n = points.get(x, (0.0, 0))
        points[x] = (s + y, n + 1)
    blocks = [([x], *points[x]) for x in sorted(points)]
    moved = True
    while moved:
        moved = False
        for i in range(len(blocks) - 1):
            if blocks[i][1] / blocks[i][2] > blocks[i + 1][1] / blocks[i + 1][2]:
                blocks[i : i + 2] = [(blocks[i][0] + blocks[i + 1][0], blocks[i][1] + blocks[i + 1][1], blocks[i][2] + blocks[i + 1][2])]
                moved = True
                break
    return {x: s / n for xs, s, n in blocks for x in xs}


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_ranges_give_the_sequential_fit(spark, ranges):
    rnd = random.Random(ranges)
    rows = [(g, x, int(rnd.random() < (x if g == "up" else 1 - x))) for g in ("up", "down") for x in (rnd.randrange(60) / 60 for _ in range(300))]
    rows += [("one", 0.5, 1), ("none", None, 1), ("none", 0.2, None), (None, 0.1, 0), (None, 0.9, 1)]
    df = spark.createDataFrame(rows, "g string, x double, y int")
    steps = fit_isotonic(df, "x", "y", "g", ranges=ranges)
    out = apply_isotonic(df.withColumn("n", F.lit("kept")), steps, "x", by="g").collect()
    assert len(out) == len(rows) and all(r.n == "kept" for r in out)
    for g in ("up", "down", "one", None):
        want = sequential([(x, y) for k, x, y in rows if k == g])
        for r in out:
            if r.g == g:
                assert abs(r.prob - want[r.x]) < 1e-12
    assert all(r.prob is None for r in out if r.g == "none")
    means = [r["value"] for r in steps.where("key = 'up'").orderBy("lo").collect()]
    assert means == sorted(set(means))


def test_pooling_lists_of_blocks_equals_pooling_all_points():
    rnd = np.random.RandomState(3)
    s, n = rnd.randint(0, 3, 1_000_000).astype(float), np.full(1_000_000, 2.0)
    x = np.arange(1_000_000.0)
    whole = pool(x, x, s, n)
    cuts = [0, 10, 250_000, 250_001, 700_000, 1_000_000]
    parts = [pool(x[a:b], x[a:b], s[a:b], n[a:b]) for a, b in zip(cuts, cuts[1:])]
    merged = pool(*zip(*[b for p in parts for b in p]))
    assert merged == whole


def test_equal_to_the_library_between_and_beyond_the_steps(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(i, rnd.random(), int(rnd.random() < 0.4)) for i in range(400)], "id int, s double, label int")
    asm = M.assembler(["s"], "f")
    want = {r.id: r.prediction for r in IsotonicRegression(featuresCol="f", labelCol="label").fit(asm.transform(df.where("id % 2 = 0"))).transform(asm.transform(df)).collect()}
    got = {r.id: r.prob for r in apply_isotonic(df, fit_isotonic(df.where("id % 2 = 0"), "s", "label", ranges=5), "s").collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
    assert fit_isotonic(df.limit(0), "s", "label").count() == 0
