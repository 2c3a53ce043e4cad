import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.plans.ordered import average_rank, exact_quantiles, running_sum

VALS = [1.0, 2.0, 4.0, 10.0, 2.0, 2.0, 7.5, 3.0, 3.0, 9.0, 1.0]


def _df(spark):
    rows = [(i % 2, v) for i, v in enumerate(VALS)] + [(2, 5.0)]
    return spark.createDataFrame(rows, "g int, v double")


@pytest.mark.parametrize("bucketed", [False, True])
def test_exact_quantiles_match_numpy(spark, request, bucketed):
    if bucketed:
        request.getfixturevalue("small_groups")
    df = _df(spark)
    q = {r["g"]: (r["q25"], r["q50"], r["q75"]) for r in
         exact_quantiles(df, "v", ["g"], [0.25, 0.5, 0.75], ["q25", "q50", "q75"]).collect()}
    pdf = df.toPandas()
    for g, grp in pdf.groupby("g"):
        exp = np.quantile(grp["v"].values, [0.25, 0.5, 0.75])
        assert np.allclose(q[g], exp), (g, q[g], exp)


def test_quantiles_reference_probe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "v double")
    r = exact_quantiles(df, "v", [], [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    assert (r["a"], r["b"], r["c"]) == (1.75, 3.0, 5.5)


@pytest.mark.parametrize("bucketed", [False, True])
def test_running_sum_paths_agree(spark, request, bucketed):
    if bucketed:
        request.getfixturevalue("small_groups")
    df = spark.range(0, 200).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 101).cast("double").alias("v"),
                                    F.lit(1).alias("one"))
    got = {(r["g"], r["v"]): r["cum_one"] for r in running_sum(df, ["g"], ["v"], ["one"]).collect()}
    pdf = df.toPandas().sort_values(["g", "v"])
    pdf["c"] = pdf.groupby("g")["one"].cumsum()
    for _, row in pdf.iterrows():
        assert got[(row["g"], row["v"])] == row["c"]


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.4), (3, 0.4), (4, 0.8)], "id int, p double")
    r = {x["id"]: (x["avg_rank"], x["pct"]) for x in average_rank(df, [], "p", "avg_rank", "pct").collect()}
    assert r[1] == (1.0, 0.25) and r[2] == (2.5, 0.625) and r[3] == (2.5, 0.625) and r[4] == (4.0, 1.0)


def test_range_partitioned_plan_has_no_bounds_and_no_whole_column_window(spark, small_groups):
    df = spark.range(0, 100).select((F.col("id") * 1.0).alias("v"), F.lit(1).alias("one"))

    def plan(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            return running_sum(df, [], ["v"], ["one"])._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    few, many = plan(8), plan(100_000)  # the number of ranges is no part of any expression
    assert abs(len(many) - len(few)) < 200 and "CASE WHEN" not in many
    physical = running_sum(df, [], ["v"], ["one"])._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("hashpartitioning" in ln and "_fw_bucket" in ln for ln in physical)  # the rows' window is dealt by range
    for i, ln in enumerate(physical):
        if "SinglePartition" in ln:  # only the totals of the ranges come together
            assert "HashAggregate" in physical[i + 1] and "_fw_bucket" in physical[i + 1], physical[i:i + 2]


def test_null_groups_and_hot_groups_are_kept(spark, small_groups):
    rows = [(None if i % 3 == 0 else i % 2, float(i * 7 % 50), 1) for i in range(150)]
    got = running_sum(spark.createDataFrame(rows, "g int, v double, one int").groupBy("g", "v").agg(F.sum("one").alias("one")), ["g"], ["v"], ["one"])
    want = {}
    for g in (None, 0, 1):
        total = 0
        for v in sorted({r[1] for r in rows if r[0] == g}):
            total += sum(1 for r in rows if r[:2] == (g, v))
            want[g, v] = total
    assert {(r.g, r.v): r.cum_one for r in got.collect()} == want
