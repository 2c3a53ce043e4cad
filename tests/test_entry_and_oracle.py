import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.oracle import compare, duck

SMOKE = "/root/testdata/sf0.001"
FAST = ["x1_stratified_folds", "x4_auc_by_model_fold", "i3_group_median_impute", "i7_frequency_encoding",
        "p_scalar_features", "t2e_mestimate_oof_encoding", "e5_describe_numeric", "e9_histogram_two_tables",
        "d4_d5_chi_square_cramers_v", "j5_p16_enrichment_flags", "r7_complementarity", "n13_simplex_grid_top10",
        "a3_within_class_mixup", "flagship_fold_impute_auc"]


def test_contract_keys(spark):
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, con, name):
    from foldwise.catalog import REGISTRY
    from foldwise.plans.joins import release

    r = compare(spark, con, REGISTRY[name], SMOKE)
    release()
    assert r["status"] == "ok", r
