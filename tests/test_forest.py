"""Permutation importance of a forest: the same values without a row for every copy."""

import math
import random

import pytest

from foldwise.operators import forest
from foldwise.operators import models as M
from foldwise.operators import select as FS


@pytest.mark.parametrize("range_rows", [10**6, 40])
def test_a_forests_copies_are_scored_and_ranked_as_spark_does(spark, monkeypatch, range_rows):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        a, b, c = rnd.randrange(3) / 1.0, rnd.gauss(0, 1), rnd.choice([0.0, 1.0, None])
        rows.append((i, None if i % 97 == 5 else int(a + b + rnd.gauss(0, 1) > 1), a, b, c, 1.0))
    df = spark.createDataFrame(rows, "id long, label int, a double, b double, c double, same double").repartition(3).cache()
    cols = ["a", "b", "c", "same"]
    known = M.assembler(cols).transform(df.where("label is not null").na.fill(0.5))
    model = M.random_forest(20, seed=1).fit(known)
    monkeypatch.setattr(forest, "RANGE_ROWS", range_rows)
    got = {(r.feature, r.rep): r.importance for r in FS.permutation_importance(model, df, cols, 3, seed=4).collect()}
    monkeypatch.setattr(FS, "tables", lambda *_: None)
    want = {(r.feature, r.rep): r.importance for r in FS.permutation_importance(model, df, cols, 3, seed=4).collect()}
    assert got == want and len(got) == 12
    assert got["same", 0] == 0.0 and got["b", 0] > 0.01


def test_a_forests_scores_are_sparks_to_the_last_bit(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(i, rnd.randrange(2), rnd.random(), rnd.choice([0.5, math.nan, 2.0])) for i in range(300)], "id long, label int, x double, y double")
    model = M.random_forest(30, seed=2).fit(M.assembler(["x", "y"]).transform(df.na.fill(1.0)))
    tables = forest.tables(model, 2)
    want = {r.id: r.prob for r in M.positive_probability(model.transform(M.assembler(["x", "y"]).transform(df))).collect()}
    import numpy as np
    rows = df.collect()
    own = forest.codes(tables, [np.array([r.x for r in rows]), np.array([r.y for r in rows])])
    assert dict(zip([r.id for r in rows], next(forest.copies(tables, own, own, [])))) == want


def test_no_row_is_made_for_a_copy(spark):
    df = spark.createDataFrame([(i, i % 2, float(i % 7), float(i % 3)) for i in range(60)], "id long, label int, x double, y double")
    model = M.random_forest(5, seed=2).fit(M.assembler(["x", "y"]).transform(df))
    plan = FS.permutation_importance(model, df, ["x", "y"], 2)._jdf.queryExecution().analyzed().toString()
    assert "features" not in plan and "UDF" not in plan
