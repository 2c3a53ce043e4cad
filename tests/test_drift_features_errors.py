from pyspark.sql import functions as F

from foldwise.functions import features as P
from foldwise.operators import drift as D
from foldwise.operators import errors as R


def test_chi_square_yates_golden(spark):
    a = spark.createDataFrame([("x",)] * 10 + [("y",)] * 20, "c string")
    b = spark.createDataFrame([("x",)] * 20 + [("y",)] * 10, "c string")
    r = D.chi_square(a, b, ["c"]).first()
    assert abs(r["chi2"] - 5.4) < 1e-9 and r["dof"] == 1
    r3 = D.chi_square(a.union(spark.createDataFrame([("z",)] * 5, "c string")), b, ["c"]).first()
    assert r3["dof"] == 2


def test_ks_and_wasserstein_edges(spark):
    a = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 3)], "v double")
    same = D.ks_wasserstein(a, a, ["v"]).first()
    assert same["ks_stat"] == 0 and abs(same["wasserstein"]) < 1e-12
    b = spark.createDataFrame([(float(v),) for v in (10, 11)], "v double")
    far = D.ks_wasserstein(a, b, ["v"]).first()
    assert far["ks_stat"] == 1.0 and abs(far["wasserstein"] - 8.5) < 1e-12


def test_rule_bins_on_edges_and_nulls(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 12.0, 12.5, 18.0, 35.0, 60.0, 100.0, -1.0, 101.0, None)], "a double")
    got = [r[0] for r in df.select(P.rule_bin("a")).collect()]
    assert got == [0, 0, 1, 1, 2, 3, 4, 2, 2, 2]


def test_apply_edges_right_closed(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(P.apply_edges("x", F.array(F.lit(1.0), F.lit(2.0)))).collect()]
    assert got == [0, 1, 2, -1]


def test_one_hot_null_is_all_zero(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "c string")
    rows = df.select(*P.one_hot("c", ["a", "b"])).collect()
    assert [tuple(r) for r in rows] == [(1, 0), (0, 0), (0, 0)]


def test_complementarity_model_without_errors(spark):
    corr = spark.createDataFrame([(1, "m1", 1), (1, "m2", 0), (2, "m1", 1), (2, "m2", 1)], "id long, model string, correct int")
    rec = R.per_record(corr.withColumn("label", F.lit(1)).withColumn("prob", F.lit(0.5)), ["m1", "m2"])
    comp = {(r["a"], r["b"]): r["complementarity"] for r in R.complementarity(R.pattern_counts(rec), ["m1", "m2"]).collect()}
    assert comp[("m1", "m2")] == 1.0 and comp[("m2", "m1")] == 1.0 and comp[("m1", "m1")] == 0.0


def test_patterns_follow_the_given_model_order_and_mark_missing_scores(spark):
    right = {"rf": [0, 0, 1, 1], "lr": [1, 0, 0, 1], "xgb": [1, None, 0, 0]}
    rows = [(i, m, 1, 0.5, c) for m, cs in right.items() for i, c in enumerate(cs) if c is not None]
    corr = spark.createDataFrame(rows, "id long, model string, label int, prob double, correct int")
    models = ["rf", "lr", "xgb"]
    rec = R.per_record(corr, models)
    assert {r.id: r.pattern for r in rec.collect()} == {0: "011", 1: "00-", 2: "100", 3: "110"}
    pat = R.pattern_counts(rec)
    comp = {(r.a, r.b): r.complementarity for r in R.complementarity(pat, models).collect()}
    assert comp["rf", "lr"] == 0.5 and comp["rf", "xgb"] == 1.0 and comp["lr", "rf"] == 0.5 and comp["xgb", "rf"] == 1.0 and comp["xgb", "lr"] == 0.5
    wrong = {r.pattern: r.w for r in pat.select("pattern", R.wrong_models("pattern", models).alias("w")).collect()}
    assert wrong["00-"] == ["rf", "lr"] and wrong["100"] == ["lr", "xgb"]
    either = {(r.a, r.b): r.or_accuracy for r in R.pairwise_or(pat, models).collect()}
    assert either["rf", "lr"] == 0.75
