"""Headline-query benchmark: runs a fixed set of registered queries on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {name: sec, ...}, "sf": ...}.

Each query is built and fully collected once; cached helper tables are released between queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_fold_impute_auc",   # folds + leak-safe imputation + AUC (the entry query)
    "x1_stratified_folds",        # bucketed running count over the whole table
    "x4_auc_by_model_fold",       # tie-aware AUC
    "i2_train_stats_by_fold",     # leave-fold-out exact medians + mode
    "i6_group_stat_features",     # grouped statistics joined back
    "t2e_mestimate_oof_encoding", # target encoding, null-safe keys
    "p10_p11_quantile_bins",      # exact quantile edges per fold
    "e5_describe_numeric",        # describe with exact quartiles
    "e10_gaussian_kde",           # KDE without a value × grid product
    "d1_d3_ks_wasserstein",       # two-sample CDF statistics
    "j5_p16_enrichment_flags",    # first-match registry lookup
    "j7_holdout_linkage",         # candidate counting linkage
    "r7_complementarity",         # pattern-grouped model pairs
    "n13_simplex_grid_top10",     # 231-point weight grid, branch and bound
    "n17_pairwise_blend_grid",    # 210 pair × weight blends, one job over pairs of scores
    "x12_repeated_cv_robust_score",
    "a3_within_class_mixup",
    "i12_feature_builder_kitchen_sink",  # every statistic of the builder, all eval folds
    "x9_x10_score_submission_files",  # 45 files, one scan
    "m1_m8_logreg_coefficients",  # a learner behind the builder
    "stream_feature_scoring",     # the fitted builder on a file stream
]


def main() -> None:
    from foldwise.catalog import REGISTRY
    from foldwise.plans.joins import release
    from foldwise.plans.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or HEADLINE
    spark = local_session(cpus=cpus, shuffle_partitions=max(8, cpus))
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        entry = REGISTRY[name]
        t0 = time.perf_counter()
        n = len(entry.run(spark, sf_dir).collect())
        times[name] = round(time.perf_counter() - t0, 3)
        rows[name] = n
        release()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
