"""Record × model error analysis on a long score table.

Everything starts from the long correctness table (id, model, prob, label, pred, correct). Pair
statistics between models (R7-R9) are computed on correctness *patterns*: records are first
grouped by their pattern (a string with one 0/1 per model, in model order), and model pairs are
expanded over that pattern table only — the fan-out is bounded by the number of models, and no
record is ever paired with another record.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.plans.joins import dim_join, join_on_keys


def correctness(scores: DataFrame, labels: DataFrame, id_col: str = "id", model: str = "model",
                prob: str = "prob", label: str = "survived",
                thresholds: Mapping[str, float] | None = None, t: float = 0.5) -> DataFrame:
    """R1 (+ J1/J6): scores ⋈ labels on id (intersection), class call per model threshold
    (T20: a rank-score model may need its own), correct = call equals label."""
    j = scores.join(labels.select(id_col, label).where(F.col(label).isNotNull()), id_col)
    thr = F.lit(t)
    if thresholds:
        pairs = []
        for k, v in thresholds.items():
            pairs += [F.lit(k), F.lit(float(v))]
        thr = F.coalesce(F.create_map(*pairs)[F.col(model)], F.lit(t))
    pred = (F.col(prob) >= thr).cast("int")
    return j.select(id_col, model, prob, F.col(label).alias("label"), pred.alias("pred"),
                    (pred == F.col(label)).cast("int").alias("correct"))


def accuracy_by_model(corr: DataFrame) -> DataFrame:
    """R2 + R12: accuracy, correct count, false positives and false negatives per model."""
    return corr.groupBy("model").agg(
        F.avg("correct").alias("accuracy"), F.sum("correct").cast("long").alias("n_correct"),
        F.count(F.lit(1)).alias("n"),
        F.sum(((F.col("pred") == 1) & (F.col("label") == 0)).cast("long")).alias("fp"),
        F.sum(((F.col("pred") == 0) & (F.col("label") == 1)).cast("long")).alias("fn"))


def per_record(corr: DataFrame, models: Sequence[str]) -> DataFrame:
    """Per record: label, number of models right, mean probability, correctness pattern: one character
    for each of ``models`` in their order, 1 right, 0 wrong, - without a score."""
    pat = F.concat(*[F.coalesce(F.max(F.when(F.col("model") == m, F.col("correct"))).cast("string"), F.lit("-"))
                     for m in models])
    return corr.groupBy("id").agg(
        F.first("label").alias("label"), F.sum("correct").cast("int").alias("correct_count"),
        F.avg("prob").alias("avg_prob"), pat.alias("pattern"))


def difficulty_distribution(records: DataFrame) -> DataFrame:
    """Records by number of models right (with percent)."""
    c = records.groupBy("correct_count").agg(F.count(F.lit(1)).alias("records"))
    return c.withColumn("pct", F.col("records") * 100.0 / F.sum("records").over(Window.partitionBy(F.lit(0))))


def hard_records(records: DataFrame, n_models: int) -> DataFrame:
    """Records that at most half of the models get right."""
    return records.where(F.col("correct_count") <= n_models // 2)


def one_correct(records: DataFrame, corr: DataFrame) -> DataFrame:
    """Records exactly one model gets right, with that model."""
    ones = records.where(F.col("correct_count") == 1)
    winner = corr.where(F.col("correct") == 1).select("id", F.col("model").alias("winner"))
    return ones.join(winner, "id")


def pattern_counts(records: DataFrame) -> DataFrame:
    """R10 input: how many records share each correctness pattern."""
    return records.groupBy("pattern").agg(F.count(F.lit(1)).alias("records"))


def _with_pairs(patterns: DataFrame, models: Sequence[str], ordered: bool) -> DataFrame:
    """Each pattern row × every model pair (a generator over a literal list of model pairs)."""
    pairs = [(i, a, j, b) for i, a in enumerate(models) for j, b in enumerate(models)
             if (i != j if ordered else i < j)]
    arr = F.array(*[F.struct(F.lit(i).alias("ia"), F.lit(a).alias("a"), F.lit(j).alias("ib"), F.lit(b).alias("b"))
                    for i, a, j, b in pairs])
    return patterns.select("pattern", "records", F.explode(arr).alias("_p")).select("pattern", "records", "_p.*")


def complementarity(patterns: DataFrame, models: Sequence[str]) -> DataFrame:
    """P(B right | A wrong) for every ordered pair, over records that both score; 1 when A makes no
    error; 0 on the diagonal. ``models`` is the list that the patterns were made with."""
    spark = patterns.sparkSession
    j = _with_pairs(patterns, models, True)
    ca = F.substring(F.col("pattern"), F.col("ia") + 1, 1)
    cb = F.substring(F.col("pattern"), F.col("ib") + 1, 1)
    agg = j.groupBy("a", "b").agg(
        F.sum(F.when((ca == "0") & (cb != "-"), F.col("records")).otherwise(0)).alias("a_wrong"),
        F.sum(F.when((ca == "0") & (cb == "1"), F.col("records")).otherwise(0)).alias("b_rescues"))
    off = agg.select("a", "b", F.when(F.col("a_wrong") == 0, F.lit(1.0))
                     .otherwise(F.col("b_rescues") / F.col("a_wrong")).alias("complementarity"))
    diag = spark.createDataFrame([(m, m, 0.0) for m in models], "a string, b string, complementarity double")
    return off.unionByName(diag)


def best_partner(comp: DataFrame, models: Sequence[str]) -> DataFrame:
    """For each model the partner with the highest complementarity (ties → earlier model)."""
    order = comp.sparkSession.createDataFrame([(m, i) for i, m in enumerate(models)], "b string, b_order int")
    c = dim_join(comp.where(F.col("a") != F.col("b")), order, ["b"], "inner")
    return c.groupBy("a").agg(F.min_by(F.struct("b", "complementarity"),
                                       F.struct(-F.col("complementarity"), F.col("b_order"))).alias("best")).select(
        "a", F.col("best.b").alias("partner"), F.col("best.complementarity").alias("complementarity"))


def pairwise_or(patterns: DataFrame, models: Sequence[str]) -> DataFrame:
    """Share of records at least one of two models gets right, for every unordered pair."""
    j = _with_pairs(patterns, models, False)
    either = (F.substring(F.col("pattern"), F.col("ia") + 1, 1) == "1") | \
             (F.substring(F.col("pattern"), F.col("ib") + 1, 1) == "1")
    scored = either | (F.substring(F.col("pattern"), F.col("ia") + 1, 1) == "0") | \
             (F.substring(F.col("pattern"), F.col("ib") + 1, 1) == "0")
    return j.groupBy("a", "b").agg(
        (F.sum(F.when(either, F.col("records")).otherwise(0)) / F.sum(F.when(scored, F.col("records")))).alias("or_accuracy"))


def wrong_models(pattern_col: str, models: Sequence[str]):
    """Names of the models a pattern gets wrong."""
    names = F.array(*[F.lit(m) for m in models])
    idx = F.sequence(F.lit(1), F.lit(len(models)))
    return F.filter(F.transform(idx, lambda i: F.when(F.substring(F.col(pattern_col), i, 1) == "0",
                                                      F.element_at(names, i))), lambda x: x.isNotNull())


def accuracy_by_confidence(corr: DataFrame, holdout: DataFrame) -> DataFrame:
    """Mean accuracy over all models for nested confidence levels all ⊃ sure ⊃ unique."""
    j = join_on_keys(corr, holdout.select("id", "confidence"), ["id"], "inner")
    lv = F.filter(F.array(F.lit("all"),
                          F.when(F.col("confidence").isin("unique", "all_agree"), F.lit("sure")),
                          F.when(F.col("confidence") == "unique", F.lit("unique"))), lambda x: x.isNotNull())
    e = j.withColumn("level", F.explode(lv))
    return e.groupBy("level").agg(F.countDistinct("id").alias("records"), F.avg("correct").alias("mean_accuracy"))
