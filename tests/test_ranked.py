"""Grid AUCs from arrays of scores: the same values as from rows, in turns and ranges or not."""

import random

import pytest
from pyspark.sql import functions as F

from foldwise.operators import blend as N
from foldwise.operators import ranked


@pytest.mark.parametrize("turn, range_rows", [(10**9, 10**9), (700, 30), (1, 7)])
def test_grid_auc_equals_the_grouped_auc_of_rows(spark, monkeypatch, turn, range_rows):
    rnd = random.Random(9)
    rows = [(rnd.choice([0, 1, 1, None]), *(rnd.choice([None, 0.1, 0.25, 0.5, 0.99, -0.0, 0.0]) for _ in range(3))) for _ in range(900)] + [(1, 0.1, 0.1, 0.1)] * 300
    df = spark.createDataFrame(rows, "label int, a double, b double, c double")
    grid, cols = [(0.2, 0.5, 0.3), (1.0, 0.0, 0.0), (0.0, 0.4, 0.6), (0.1, 0.1, 0.8)], ["a", "b", "c"]
    monkeypatch.setattr(ranked, "TURN", turn)
    monkeypatch.setattr(ranked, "RANGE_ROWS", range_rows)
    want = N._exact(N.score_tuples(df, cols), cols, dict(enumerate(grid)), []).orderBy("grid_id")
    got = N.grid_auc(df, cols, grid).orderBy("grid_id")
    assert got.columns == want.columns and got.collect() == want.collect() and got.count() == 4
    one = N.grid_auc(df.where("label = 1"), cols, grid)
    assert {r.auc for r in one.collect()} == {None} and N.grid_auc(df.limit(0), cols, grid).count() == 0


def test_no_row_is_made_for_a_tuple_and_point(spark):
    df = spark.createDataFrame([(i % 2, i / 10, 1.0) for i in range(20)], "label int, a double, b double")
    plan = N.grid_auc(df, ["a", "b"], [(0.5, 0.5), (1.0, 0.0)])._jdf.queryExecution().analyzed().toString()
    assert "explode" not in plan and plan.count("MapInArrow") == 1
