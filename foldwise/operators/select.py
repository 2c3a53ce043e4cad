"""Permutation importance, verdicts, stability selection and subset evaluation.

Permutation importance is one job per fitted model: validation rows are numbered once, and in each
repeat once more in the repeat's own order; the row at a position is joined with the row that comes there
in that order, whole (rows x repeats are shuffled, whatever the number of features). Only then, map-side,
a copy of the row is made for every feature, which takes that feature from the partner; the model scores
every copy in one ``transform``, and a grouped AUC gives the drop for all features and repeats at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.columns import HASH_SCALE

from foldwise.operators.forest import Forest, coded, paired_auc, tables
from foldwise.operators.metrics import auc
from foldwise.operators.models import assembler, positive_probability
from foldwise.plans.joins import persisted
from foldwise.plans.ordered import running_sum

# fixed values: importance verdict thresholds
STRONG, WEAK = 0.01, 0.001


def _positions(df: DataFrame, group_cols: Sequence[str], key, out: str, profile: tuple[int, int, int] | None = None) -> DataFrame:
    """0-based position of each row inside its group when ordered by an md5 uniform of ``key``. ``profile``:
    ``group_profile`` of ``df``, where known."""
    u = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(HASH_SCALE)
    d = df.withColumn("_pu", u).withColumn("_one", F.lit(1))
    r = running_sum(d, list(group_cols), ["_pu", "id"], ["_one"],
                    bucket=lambda n: F.least(F.floor(F.col("_pu") * n), F.lit(n - 1)).cast("int"), profile=profile)
    return r.withColumn(out, F.col("cum__one") - 1).drop("_pu", "_one", "cum__one")


def _partners(rows: DataFrame, taken: Column, n_repeats: int, seed: int, n: int | None = None) -> DataFrame:
    """``rows`` (``n`` of them) for each repeat (rep), with ``taken`` of the row that comes in its place in the repeat's
    order (_src)."""
    own = _positions(rows, [], F.concat_ws("|", F.lit("own"), F.col("id").cast("string")), "_at", n and (n, 1, n))
    own = own.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))))
    src = rows.select("id", taken.alias("_src"), F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))).alias("rep"))
    src = _positions(src, ["rep"], F.concat_ws("|", F.lit(seed), F.col("rep").cast("string"), F.col("id").cast("string")), "_at", n and (n, n_repeats, n * n_repeats))
    return own.join(src.drop("id"), ["rep", "_at"]).drop("_at")


def _forest_importance(forest: Forest, val_rows: DataFrame, cols: list[str], feats: list[str], n_repeats: int, seed: int, label: str) -> DataFrame:
    """``permutation_importance`` of a forest: rows meet as codes of a few bytes, and no copy becomes a row."""
    rows = persisted(coded(val_rows, forest, cols, label))
    n = rows.count()
    pairs = _partners(rows, F.col("code"), n_repeats, seed, n).select("rep", "label", F.col("code").alias("own"), F.col("_src").alias("other"))
    pa = persisted(paired_auc(pairs, forest, [cols.index(f) for f in feats], rows, n))
    base = pa.where("what = -1 and rep = 0").select(F.lit(0).alias("_k"), F.col("auc").alias("base_auc"))
    names = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("what") + 1)
    pa = pa.where("what >= 0").withColumn("_k", F.lit(0)).join(F.broadcast(base), "_k")
    return pa.select(names.alias("feature"), "rep", (F.col("base_auc") - F.col("auc")).alias("importance"))


def permutation_importance(model, val_rows: DataFrame, cols: Sequence[str], n_repeats: int = 10,
                           seed: int = 42, label: str = "label", features: Sequence[str] | None = None) -> DataFrame:
    """mean and std (over repeats) of the AUC drop when one feature is permuted."""
    cols = list(cols)
    feats = list(features) if features is not None else cols
    forest = tables(model, len(cols))
    if forest is not None:
        return _forest_importance(forest, val_rows, cols, feats, n_repeats, seed, label)
    base = positive_probability(model.transform(assembler(cols).transform(val_rows)))
    base_auc = auc(base, label, "prob").select(F.col("auc").alias("base_auc"))
    j = _partners(val_rows, F.struct(*feats), n_repeats, seed)
    j = j.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in feats])))
    j = j.select(*[F.when(F.col("feature") == c, F.col(f"_src.{c}")).otherwise(F.col(c)).alias(c) if c in feats else c
                   for c in j.columns if c != "_src"])
    scored = positive_probability(model.transform(assembler(cols).transform(j)))
    pa = auc(scored, label, "prob", ["feature", "rep"])
    pa = pa.withColumn("_k", F.lit(0)).join(F.broadcast(base_auc.withColumn("_k", F.lit(0))), "_k")
    drop = pa.select("feature", "rep", (F.col("base_auc") - F.col("auc")).alias("importance"))
    return drop


def importance_summary(drops: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """F1 + F2: mean / std of the drop per feature and the verdict STRONG / weak / DROP?."""
    s = drops.groupBy(*by).agg(F.avg("importance").alias("mean"), F.stddev_pop("importance").alias("std"))
    return s.withColumn("verdict", F.when(F.col("mean") > STRONG, "STRONG").when(F.col("mean") > WEAK, "weak")
                        .otherwise("DROP?"))


def stability_selection(pi: DataFrame, threshold: float = WEAK, min_share: float = 0.6,
                        run_col: str = "run") -> DataFrame:
    """per feature, share of runs with importance above ``threshold``, mean and (population)
    std; selected when the share reaches ``min_share``."""
    s = pi.groupBy("feature").agg(
        F.avg((F.col("importance") > threshold).cast("double")).alias("share"),
        F.avg("importance").alias("mean"), F.stddev_pop("importance").alias("std"),
        F.countDistinct(run_col).alias("runs"))
    return s.withColumn("selected", (F.col("share") >= min_share).cast("int"))
