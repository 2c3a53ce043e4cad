"""Count vectors against per-fold computation, and branch and bound against every grid point."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import blend as N
from foldwise.operators.foldstats import EVAL, fold_mode, fold_quantiles, fold_shares, value_vectors, vector_columns
from foldwise.operators.spec import preset

K = 3


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    return [(i, rnd.randrange(K), rnd.choice([None, "a", "b"]), None if rnd.random() < 0.1 else float(rnd.randrange(40)), rnd.choice(["x", "y", None])) for i in range(400)]


def trained(rows, e, g):
    return [r for r in rows if r[1] != e and r[2] == g]


@pytest.mark.parametrize("large", [False, True])
def test_quantiles_of_every_eval_fold_come_from_one_row_a_value(spark, rows, request, large):
    if large:
        request.getfixturevalue("small_groups")
    df = spark.createDataFrame(rows, "id int, fold int, g string, v double, c string")
    vectors = value_vectors(df, "v", ["g"], "fold", K)
    assert vectors.columns == ["g", "v", *vector_columns(K)]
    assert vectors.count() == len({(r[2], r[3]) for r in rows if r[3] is not None})  # no copy per fold
    qs = [0.0, 0.2, 0.5, 0.75, 1.0]
    got = {(r[EVAL], r.g): [r[f"q{i}"] for i in range(5)] for r in fold_quantiles(df, "v", ["g"], qs, [f"q{i}" for i in range(5)], "fold", K).collect()}
    assert len(got) == 3 * (K + 1)
    for (e, g), q in got.items():
        assert np.allclose(q, np.quantile([r[3] for r in trained(rows, e, g) if r[3] is not None], qs)), (e, g)


def test_modes_and_shares(spark, rows):
    df = spark.createDataFrame(rows, "id int, fold int, g string, v double, c string")
    for r in fold_mode(df, "c", ["g"], "fold", K).collect():
        of = [x[4] for x in trained(rows, r[EVAL], r.g) if x[4] is not None]
        assert r.c_mode == min(set(of), key=lambda c: (-of.count(c), c))
    for r in fold_shares(df, "c", "fold", K).collect():
        of = [x[4] for x in rows if x[1] != r[EVAL] and x[4] is not None]
        assert abs(r.c_freq - of.count(r.c) / len(of)) < 1e-12


def test_value_only_in_one_fold_has_no_row_where_that_fold_is_left_out(spark):
    df = spark.createDataFrame([(0, 1.0, "a"), (1, 2.0, "b")], "fold int, v double, g string")
    got = {(r[EVAL], r.g) for r in fold_quantiles(df, "v", ["g"], [0.5], ["m"], "fold", 2).collect()}
    assert got == {(-1, "a"), (1, "a"), (-1, "b"), (0, "b")}


def test_builder_plan_has_no_window_over_a_whole_column(spark, rows):
    cols = "id int, fold int, grp int, flag int, x1 double, x2 double, cat string, c1 int, c2 int"
    df = spark.createDataFrame([(r[0], r[1], 1 + r[0] % 3, r[0] % 2, r[3], float(r[0] % 17), r[4], 0, 1) for r in rows], cols)
    model = preset("kitchen_sink", levels=("x", "y"), classes=(1, 2, 3)).fit(df, "fold", K)
    plan = model.transform(df.withColumn(EVAL, F.col("fold")))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("buckets", [1, 16, 512])
def test_grid_top_equals_the_exhaustive_search(spark, buckets):
    rnd = random.Random(buckets)
    data = [(i, i % 2, round(rnd.random() * 0.6 + 0.2 * (i % 2), 2), round(rnd.random(), 2), round(rnd.random() * 0.8 + 0.1 * (i % 2), 2), i % 3) for i in range(600)]
    df = spark.createDataFrame(data, "id int, label int, a double, b double, c double, seed int")
    grid = N.simplex_grid(3, 0.1)
    every = N.grid_auc(df, ["a", "b", "c"], grid, extra_keys=["seed"]).collect()
    top = N.grid_top(df, ["a", "b", "c"], grid, 4, extra_keys=["seed"], always=[7], buckets=buckets).collect()
    for s in range(3):
        best = sorted(((-round(r.auc, 9), r.grid_id) for r in every if r.seed == s))[:4]
        want = {g: -a for a, g in best} | {7: round(next(r.auc for r in every if (r.seed, r.grid_id) == (s, 7)), 9)}
        assert {r.grid_id: round(r.auc, 9) for r in top if r.seed == s} == want
    bounds = {(r.seed, r.grid_id): r for r in N.auc_bounds(N.score_tuples(df, ["a", "b", "c"], extra_keys=["seed"]), ["a", "b", "c"], dict(enumerate(grid)), ["seed"], buckets).collect()}
    for r in every:
        assert bounds[r.seed, r.grid_id].lo - 1e-12 <= r.auc <= bounds[r.seed, r.grid_id].hi + 1e-12


def test_grid_top_with_one_class_only(spark):
    df = spark.createDataFrame([(1, 1, 0.3, 0.4), (2, 1, 0.5, 0.1)], "id int, label int, a double, b double")
    got = N.grid_top(df, ["a", "b"], [(1.0, 0.0), (0.0, 1.0)], 1).collect()
    assert len(got) == 1 and got[0].auc is None


def test_pairs_equal_a_grid_of_each_pair(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(i, i % 2, *(round(rnd.random(), 2) for _ in range(3))) for i in range(300)], "id int, label int, a double, b double, c double")
    got = {(r.a, r.b, r.w): r.auc for r in N.pair_grid_auc(df, ["a", "b", "c"], [0.0, 0.3, 1.0]).collect()}
    assert len(got) == 9
    for (a, b, w), auc in got.items():
        assert abs(auc - N.grid_auc(df, [a, b], [(w, 1.0 - w)]).first().auc) < 1e-9
