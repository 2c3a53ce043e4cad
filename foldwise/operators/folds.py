"""Stratified, shuffled, seeded k-fold assignment as a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import HASH_SCALE, hash_uniform
from foldwise.plans.ordered import running_sum


def _hash_bucket(n: int):
    return F.least(F.floor(F.col("_fw_u") * n), F.lit(n - 1)).cast("int")


def assign_folds(df: DataFrame, label: str = "label", id_col: str = "id", k: int = 5,
                 seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold = (position within the label class when ordered by md5(seed|id), then id) mod k.

    Within each class consecutive positions go round-robin, so per-class fold sizes differ by at most
    one. The position is a running count over (class, hash bucket) — the hash is uniform, so buckets
    are equal-sized by construction and a class of any size spreads over as many as its rows need.
    """
    u = "_fw_u"
    keyed = df.withColumn(u, hash_uniform(seed, id_col)).withColumn("_fw_one", F.lit(1))
    numbered = running_sum(keyed, [label], [u, id_col], ["_fw_one"], bucket=_hash_bucket)
    return numbered.withColumn(out, ((F.col("cum__fw_one") - 1) % k).cast("int" if k < 2 ** 31 else "long")).drop(
        u, "_fw_one", "cum__fw_one")


def assign_repeated_folds(df: DataFrame, seeds, label: str = "label", id_col: str = "id", k: int = 5,
                          out: str = "fold") -> DataFrame:
    """Fold numbers for several seeds in one job — rows are repeated per seed (a bounded
    parameter list) and numbered with one running count grouped by (seed, class)."""
    u = "_fw_u"
    rep = df.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seeds])))
    text = F.concat(F.col("seed").cast("string"), F.lit("|"), F.col(id_col).cast("string"))
    rep = rep.withColumn(u, F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(HASH_SCALE))
    rep = rep.withColumn("_fw_one", F.lit(1))
    numbered = running_sum(rep, ["seed", label], [u, id_col], ["_fw_one"], bucket=_hash_bucket)
    return numbered.withColumn(out, ((F.col("cum__fw_one") - 1) % k).cast("int")).drop(
        u, "_fw_one", "cum__fw_one")
