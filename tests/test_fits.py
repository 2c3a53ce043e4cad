"""Independent fits: side by side, rows read once, in no more partitions than they need."""
import threading

import pytest
from pyspark.sql import functions as F

from foldwise.operators import augment as A
from foldwise.operators import cv as CV
from foldwise.operators import models as M
from foldwise.operators.network import Network
from foldwise.operators.fits import Group, fit_groups
from foldwise.operators.foldstats import EVAL
from foldwise.plans.joins import packed


def _rows(spark, n=300, parts=4):
    d = spark.range(0, n, 1, parts)
    u = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    return d.select("id", (F.col("id") % 3).cast("int").alias(EVAL), u.alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                    (u + (F.col("id") % 5) / 10.0 > 0.7).cast("int").alias("label"))


class Meeting:
    """An estimator that ends only while another one is being fitted."""
    barrier = None

    def fit(self, df):
        df.count()
        Meeting.barrier.wait()
        return M.logistic(1.0, 100, max_iter=3).fit(df)


def test_small_fits_run_side_by_side(spark):
    rows = _rows(spark)
    Meeting.barrier = threading.Barrier(2, timeout=60)
    sc = CV.oof_scores(rows, rows, ["a", "b"], {"x": lambda d, n: Meeting(), "y": lambda d, n: Meeting()}, 3)
    got = {(r["model"], r["fold"]): r["count"] for r in sc.groupBy("model", "fold").count().collect()}
    assert got == {(m, f): 100 for m in "xy" for f in range(3)}


def test_all_small_fits_of_a_search_run_at_the_same_time(spark):
    """Four learners on five folds: no learner of a fold waits for another one, and a large group's fits still come one by one."""
    rows = _rows(spark).withColumn(EVAL, (F.col("id") % 5).cast("int"))
    Meeting.barrier = threading.Barrier(20, timeout=60)
    sc = CV.oof_scores(rows, rows, ["a", "b"], {x: lambda d, n: Meeting() for x in "vxyz"}, 5)
    assert sc.count() == 1200
    Meeting.barrier = threading.Barrier(2, timeout=2)
    with pytest.raises(threading.BrokenBarrierError):
        fit_groups([Group(rows, 8_000_000, [(["a"], Meeting()), (["b"], Meeting())])])


def test_fits_of_several_matrices_run_side_by_side(spark):
    rows = _rows(spark)
    Meeting.barrier = threading.Barrier(6, timeout=60)
    both = CV.oof_scores_of([(rows, rows, ["a", "b"]), (rows, rows.where("id < 150"), ["a"])], {"x": lambda d, n: Meeting()}, 3)
    assert [sc.count() for sc in both] == [300, 150]
    alone = CV.oof_scores(rows, rows.where("id < 150"), ["a"], {"x": lambda d, n: M.logistic(1.0, 100, max_iter=3)}, 3)
    assert {r["id"]: r["prob"] for r in both[1].collect()} == pytest.approx({r["id"]: r["prob"] for r in alone.collect()}, abs=1e-9)


def test_training_rows_are_read_once_for_all_learners(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = _rows(spark)
    counted = rows.mapInArrow(count, rows.schema)
    models = fit_groups([Group(counted, 300, [(cols, M.logistic(C, 300, max_iter=5)) for cols in (["a"], ["a", "b"]) for C in (0.1, 1.0)])])
    assert len(models[0]) == 4 and [m.stages[-1].numFeatures for m in models[0]] == [1, 1, 2, 2]
    assert seen.value == 300


def test_subsets_and_several_models_score_as_single_ones(spark):
    rows = _rows(spark)
    make = lambda d, n: M.logistic(1.0, n, max_iter=20)
    sc = CV.oof_scores(rows, rows, ["a", "b"], {"two": make, "one": make}, 3, subsets={"one": ["a"]})
    for name, cols in (("two", ["a", "b"]), ("one", ["a"])):
        alone = {r["id"]: r["prob"] for f in range(3) for r in M.positive_probability(make(2, 100).fit(
            M.assembler(cols).transform(rows.where(F.col(EVAL) == f))).transform(M.assembler(cols).transform(rows.where(F.col(EVAL) == f)))).collect()}
        assert {r["id"]: r["prob"] for r in sc.where(F.col("model") == name).collect()} == pytest.approx(alone, abs=1e-9)


def test_few_rows_lie_in_few_partitions(spark):
    most = 2 * spark.sparkContext.defaultParallelism
    assert packed(spark.range(0, 1000, 1, 500), 1000).rdd.getNumPartitions() == most
    assert packed(spark.range(0, 1000, 1, 3), 1000).rdd.getNumPartitions() == 3
    assert packed(spark.range(0, 1000, 1, 500), 1000, bagged=False).rdd.getNumPartitions() == 1
    assert packed(spark.range(0, 1000, 1, 500), 100 * 50_000, bagged=False).rdd.getNumPartitions() == 100


def test_shared_positions_give_the_same_mixup(spark):
    rows = _rows(spark)
    pos = A.class_positions(rows, ["a", "b"], group_cols=[EVAL])
    for alpha in (0.2, 0.4):
        own, shared = (sorted(map(tuple, A.mixup(rows, ["a", "b"], n_aug=5, alpha=alpha, group_cols=[EVAL], **kw).collect()))
                       for kw in ({}, {"positions": pos}))
        assert own == shared and len(own) == 30


def test_network_scales_its_rows_once(spark, monkeypatch):
    from foldwise.operators import network

    made, blocks = [], network._blocks
    monkeypatch.setattr(network, "_blocks", lambda *a: made.append(blocks(*a)) or made[-1])
    df = M.assembler(["a", "b"]).transform(_rows(spark))
    model = Network((4,), max_iter=5).fit(df)
    assert len(made) == 1 and len(model.history) == 5
    assert all(h is not None for _, h in model.history) and not made[0].is_cached


def test_full_fit_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    class Features:
        columns = ["a", "b"]

        def transform(self, rows, keep):
            return rows.mapInArrow(count, rows.schema).select(*keep, *self.columns)

    rows = _rows(spark).drop(EVAL)
    model, scored, fitted = CV.fit_full_and_score(rows, rows.limit(0), lambda d, n: M.logistic(1.0, n, max_iter=5), Features())
    assert seen.value == 300
    assert scored.columns == ["id", "prob"] and "features" in fitted.columns


def test_meta_folds_read_their_input_once(spark):
    """The scores come out of a join and a fold numbering; the folds of the seeds are numbered over them in three passes."""
    from foldwise.catalog.modeling import META_SEEDS, _meta_folds

    w = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("label"), (F.col("id") / 40).alias("m1"))
    folds = _meta_folds(w)
    assert w.storageLevel.useMemory
    assert folds.count() == 40 * len(META_SEEDS)
