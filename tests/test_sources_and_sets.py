"""One-scan scoring of many files, learned levels, grouping sets, permutation by one partner join."""

import pytest
from pyspark.sql import functions as F

from foldwise.operators import select as FS
from foldwise.operators.drift import by_sets, drift_ranking
from foldwise.operators.profile import histogram
from foldwise.operators.spec import FeatureSpec, preset
from foldwise.sources import files as IO


def test_files_are_scored_in_one_scan(spark, tmp_path):
    rows = [(i, (i * 7 % 10) / 10, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, prob double, label int")
    for name in ("plain", "with space"):
        df.select("id", "prob").coalesce(2).write.option("header", "false").csv(str(tmp_path / name))
    (tmp_path / "single.csv").write_text("".join(f"{i},{1 - p}\n" for i, p, _ in rows))
    files = {"a": str(tmp_path / "plain"), "b": str(tmp_path / "with space"), "c": str(tmp_path / "single.csv")}
    long = IO.scores_from_files(spark, files)
    assert sorted(r.model for r in long.select("model").distinct().collect()) == ["a", "b", "c"] and long.count() == 120
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan
    labels = df.select("id", "label", F.when(F.col("id") < 10, "unique").when(F.col("id") < 20, "all_agree").when(F.col("id") < 39, "mixed").alias("confidence"))
    labels = labels.withColumn("label", F.when(F.col("id") != 5, F.col("label")))  # not linked: no label
    got = {(r.model, r.level): r for r in IO.score_files(spark, files, labels).collect()}
    assert len(got) == 9
    for (model, level), r in got.items():
        of = [(p if model != "c" else 1 - p, y) for i, p, y in rows if i != 5 and (level == "all" or i < (10 if level == "unique" else 20))]
        pos, neg = [p for p, y in of if y], [p for p, y in of if not y]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert (r.n_pos, r.n_neg) == (len(pos), len(neg)) and abs(r.auc - want) < 1e-9
    assert IO.scores_from_files(spark, {}).count() == 0


def test_levels_are_learned_from_the_training_rows(spark, monkeypatch):
    cols = "id int, fold int, grp int, flag int, x1 double, x2 double, cat string, c1 int, c2 int"
    train = spark.createDataFrame([(i, i % 2, 1, 0, 1.0, 2.0, [None, "z", "b"][i % 3], 0, 0) for i in range(12)], cols)
    test = spark.createDataFrame([(100, 0, 1, 0, 1.0, 2.0, "new", 0, 0)], cols)
    assert FeatureSpec().levels is None
    model = preset("minimal").fit(train, "fold", 2)
    assert [c for c in model.columns if c.startswith("cat_") and c != "cat_missing"] == ["cat_b", "cat_z"]
    row = model.transform(test.withColumn("eval_fold", F.lit(-1))).first()
    assert (row.cat_b, row.cat_z) == (0, 0)  # unseen: all zeros, no new column
    monkeypatch.setattr("foldwise.operators.spec.MAX_LEVELS", 1)
    with pytest.raises(ValueError):
        preset("minimal").fit(train, "fold", 2)


def test_grouping_sets_are_one_scan(spark):
    df = spark.createDataFrame([(i % 2, None if i % 3 == 0 else i % 3, float(i)) for i in range(30)], "a int, b int, v double")
    out = by_sets(df, [["a"], ["a", "b"], []], F.sum("v").alias("s"), F.count("*").alias("n"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = {(r._set, r.a, r.b): (r.s, r.n) for r in out.collect()}
    want = {(2, None, None): (435.0, 30)}
    for i in range(30):
        a, b = i % 2, None if i % 3 == 0 else i % 3
        for key in ((0, a, None), (1, a, b)):
            s, n = want.get(key, (0.0, 0))
            want[key] = (s + i, n + 1)
    assert got == want


def test_histogram_shows_empty_bins(spark):
    df = spark.createDataFrame([("x", 0.0), ("x", 10.0), ("y", 4.0), (None, 1.0), ("x", None)], "g string, v double")
    got = {(r.g, r.bin): r.n for r in histogram(df, ["v"], 5, by=["g"]).collect()}
    assert len(got) == 15 and got["x", 0] == got["x", 4] == got["y", 2] == got[None, 0] == 1 and sum(got.values()) == 4
    assert [(r.bin, r.n) for r in histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), ["v"], 5).collect()] == [(0, 2)]


def test_drift_ranking_begins_with_the_least_p_value(spark):
    a = spark.createDataFrame([(float(i), float(i % 5), "u") for i in range(200)], "x double, y double, c string")
    b = spark.createDataFrame([(float(i) + 90, float(i % 5), "uv"[i % 2]) for i in range(200)], "x double, y double, c string")
    rows = drift_ranking(a, b, ["y", "x"], ["c"]).collect()
    assert [r.p_value for r in rows] == sorted(r.p_value for r in rows) and rows[-1]["column"] == "y"


def test_permutation_takes_a_feature_from_one_partner_per_repeat(spark):
    seen = []
    rows = spark.createDataFrame([(i, i % 2, float(i), float(-i), 3.0) for i in range(50)], "id long, label int, a double, b double, c double")

    class Capture:
        def transform(self, df):
            seen.append(df)
            return df

    import foldwise.operators.select as S

    old = S.assembler, S.positive_probability
    S.assembler, S.positive_probability = (lambda cols: Capture()), (lambda d: d.withColumn("prob", F.col("a") / 100))
    try:
        drops = FS.permutation_importance(Capture(), rows, ["a", "b", "c"], 4, seed=1, features=["a", "b"]).collect()
    finally:
        S.assembler, S.positive_probability = old
    assert {(r.feature, r.rep) for r in drops} == {(f, k) for f in "ab" for k in range(4)}
    assert all(abs(r.importance) < 1e-12 for r in drops if r.feature == "b")  # the score doesn't use it
    copies = next(d for d in seen if "feature" in d.columns).collect()
    assert len(copies) == 50 * 4 * 2
    for rep in range(4):
        for f, other, sign in (("a", "b", 1), ("b", "a", -1)):
            of = [r for r in copies if r.rep == rep and r.feature == f]
            assert sorted(sign * r[f] for r in of) == [float(i) for i in range(50)]  # a permutation
            assert all(r[other] == -sign * r.id and r.c == 3.0 for r in of)  # the rest stays
            assert sum(sign * r[f] != r.id for r in of) > 30
