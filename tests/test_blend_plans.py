"""Plans of the score table that the blend queries share, and how many points a search scores exactly."""

from pyspark.sql import functions as F

from foldwise.operators import blend as N
from foldwise.plans.ordered import average_rank


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_few_values_are_broadcast(spark):
    """Many rows share a score: joined by shuffle, all rows of a score would lie in one task."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(60).select("id", F.lit("m").alias("model"), (F.col("id") % 3 / 2.0).alias("prob"))
        ranked = average_rank(rows, ["model"], "prob", out="r")
        plan = _plan(ranked)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r["prob"]: r["r"] for r in ranked.collect()} == {0.0: 10.5, 0.5: 30.5, 1.0: 50.5}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wide_shuffles_a_row_per_key_once(spark):
    rows = [(i, m, i / 10.0 if m == "a" else None if i == 2 else i / 20.0, float(i)) for i in range(4) for m in ("a", "b") if (i, m) != (3, "a")]
    out = N.wide(spark.createDataFrame(rows, "id int, model string, prob double, rank double"), ["a", "b"], keys=("id",), more={"r_": "rank"})
    assert _plan(out).count("Exchange") == 1
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0.0, 0.0, 0.0, 0.0), (1, 0.1, 0.05, 1.0, 1.0), (2, 0.2, None, 2.0, 2.0), (3, None, 0.15, None, 3.0)]


def test_second_bound_leaves_few_points(spark, monkeypatch):
    """Points too close for the coarse bounds are told apart by the finer ones; the best are those of the full grid."""
    rows = spark.range(3000).select(F.col("id"), (F.col("id") % 2).cast("int").alias("label"))
    u = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(100_003)) / 100_003.0
    rows = rows.select("label", (u("a") + 0.3 * F.col("label")).alias("a"), (u("b") + 0.1 * F.col("label")).alias("b"))
    grid, scored = N.simplex_grid(2, 0.05), []
    exact = N._exact
    monkeypatch.setattr(N, "_exact", lambda t, c, g, e: scored.append(len(g)) or exact(t, c, g, e))
    top = [(r["grid_id"], round(r["auc"], 9)) for r in N.grid_top(rows, ["a", "b"], grid, 2, buckets=16, rounds=1).collect()]
    fine = [(r["grid_id"], round(r["auc"], 9)) for r in N.grid_top(rows, ["a", "b"], grid, 2, buckets=16, rounds=3).collect()]
    full = sorted(((round(r["auc"], 9), -r["grid_id"]) for r in N.grid_auc(rows, ["a", "b"], grid).collect()), reverse=True)[:2]
    assert sorted(top) == sorted(fine) == sorted((-g, a) for a, g in full)
    assert scored[1] < scored[0]


def test_scores_of_a_row_are_repeated_not_read_again(spark):
    from foldwise.catalog.blending import _long

    wide = spark.createDataFrame([(1, 0.25, 0.5), (0, None, 0.75)], "label int, a double, b double").repartition(2)
    out = _long(wide, "method", {"a": F.col("a"), "sum": F.col("a") + F.col("b")})
    assert _plan(out).count("Exchange") == 1 and "Union" not in _plan(out)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [("a", 1, 0.25), ("a", 0, None), ("sum", 1, 0.75), ("sum", 0, None)]))
