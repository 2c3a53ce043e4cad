from pyspark.sql import functions as F

from foldwise.operators.metrics import auc, calibration_curve, classification_metrics


def test_auc_golden_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "prob double, label int")
    assert auc(df).first()["auc"] == 0.875


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1)], "prob double, label int")
    assert auc(df).first()["auc"] is None


def test_auc_invariant_to_monotone_transform(spark, small_groups):
    df = spark.range(0, 300).select(((F.col("id") * 37 % 97) / 97.0).alias("prob"),
                                    ((F.col("id") * 11 % 5) < 2).cast("int").alias("label"))
    a = auc(df).first()["auc"]
    b = auc(df.withColumn("prob", F.exp(F.col("prob") * 3))).first()["auc"]
    assert abs(a - b) < 1e-12


def test_metrics_and_calibration(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 0), (0.6, 0), (0.3, 1)], "prob double, label int")
    m = classification_metrics(df).first()
    assert m["accuracy"] == 0.5 and abs(m["brier"] - (0.01 + 0.04 + 0.36 + 0.49) / 4) < 1e-12
    bins = {r["bin"]: r["n"] for r in calibration_curve(df).collect()}
    assert bins == {8: 1, 1: 1, 5: 1, 2: 1}
