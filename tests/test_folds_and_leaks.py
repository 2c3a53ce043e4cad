from pyspark.sql import functions as F

from foldwise.operators.folds import assign_folds
from foldwise.operators.impute import fit_imputer


def test_fold_sizes_balanced_and_deterministic(spark, small_groups):
    df = spark.range(0, 503).select("id", ((F.col("id") * 7) % 3 == 0).cast("int").alias("label"))
    f1 = assign_folds(df, k=5, seed=42)
    counts = f1.groupBy("label", "fold").count().toPandas()
    for _, g in counts.groupby("label"):
        assert g["count"].max() - g["count"].min() <= 1
    f2 = assign_folds(df, k=5, seed=42)
    a = {r["id"]: r["fold"] for r in f1.collect()}
    b = {r["id"]: r["fold"] for r in f2.collect()}
    assert a == b


def test_statistics_for_fold_ignore_that_folds_rows(spark):
    rows = [(i, i % 5, 1 + i % 3, float(i % 17) if i % 4 else None, float(i), "a" if i % 2 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, fold int, grp int, x1 double, x2 double, cat string")
    g1, _ = fit_imputer(df, "grp", ["x1"], ["cat"], "fold", 5)
    edited = df.withColumn("x1", F.when(F.col("fold") == 2, F.lit(1000.0)).otherwise(F.col("x1")))
    g2, _ = fit_imputer(edited, "grp", ["x1"], ["cat"], "fold", 5)
    a = {(r["eval_fold"], r["grp"]): r["x1_median"] for r in g1.where("eval_fold = 2").collect()}
    b = {(r["eval_fold"], r["grp"]): r["x1_median"] for r in g2.where("eval_fold = 2").collect()}
    assert a == b
    c = {(r["eval_fold"], r["grp"]): r["x1_median"] for r in g2.where("eval_fold = 1").collect()}
    assert any(c[k] != v for k, v in {(1, g): a[(2, g)] for g in (1, 2, 3)}.items())
