"""Every fit gets the row count of its own training rows, which sets the regularisation."""

import pytest
from pyspark.sql import functions as F

from foldwise.operators import models as M
from foldwise.operators.cv import EVAL, fold_sizes, nested_meta_cv, oof_scores, training_frames


def _rows(spark, n=60):
    i = F.col("id")
    return spark.range(n).select("id", (i % 2).cast("int").alias("label"), (i % 7).cast("double").alias("s"),
                                 (i % 3).cast("int").alias("fold"), ((i / 2).cast("int") % 3).alias("inner"))


def test_fits_get_their_folds_rows(spark):
    d = _rows(spark).where("fold < 2 or id < 30")  # folds of 20, 20 and 10 rows
    fit = training_frames(d, "fold", 3)
    assert fold_sizes(fit) == {0: 30, 1: 30, 2: 40}
    seen = []
    oof = oof_scores(fit, d.withColumn(EVAL, F.col("fold")), ["s"],
                     {"lr": lambda _, n: seen.append(n) or M.logistic(1.0, n, max_iter=2)}, 3)
    assert seen == [30, 30, 40]
    assert sorted(r.id for r in oof.select("id").collect()) == sorted(r.id for r in d.select("id").collect())


def test_nested_fits_get_their_own_rows(spark, monkeypatch):
    seen, real = [], M.logistic
    monkeypatch.setattr(M, "logistic", lambda c, n, **kw: seen.append(n) or real(c, n, **kw))
    d = _rows(spark)
    nested_meta_cv(d, ["s"], [1.0], "fold", "inner", 2, max_iter=2)
    want = []
    for f in range(2):
        outer = d.where(F.col("fold") != f)
        want += [outer.where(F.col("inner") != g).count() for g in range(2)] + [outer.count()]
    assert seen == want


def test_mlp_refuses_weights():
    with pytest.raises(ValueError):
        M.factory("mlp", 2, weight="w")
