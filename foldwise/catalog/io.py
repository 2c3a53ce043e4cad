"""Registered queries: file sources and sinks (S1-S3, S6-S8) and the streaming feature scorer.

Files are written under the session's shared checkpoint folder (``spark.checkpoint.dir``), in a
fresh sub-folder per call, and read back with declared schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.catalog import sql as S
from foldwise.catalog.builder import CATS, GRPS, _builder_sql
from foldwise.catalog.common import K, split
from foldwise.catalog.errors import BASE
from foldwise.catalog.linkage import HOLDOUT_SQL, holdout_labels
from foldwise.catalog.registry import register
from foldwise.operators.errors import correctness, per_record
from foldwise.operators.spec import preset
from foldwise.plans.session import ensure_checkpoint_dir
from foldwise.sources import files as IO
from foldwise.sources.tables import PSEUDO_MODELS, observations, pseudo_scores, seeded_scores
from foldwise.streaming.score_stream import feature_stream, run_to_table

W = S.with_


def _scratch(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/foldwise-{what}-{uuid.uuid4().hex}"


@register("s1_s3_s7_submission_roundtrip", ops=["S1", "S2", "S3", "S7"], sql=W(S.OBS) +
          f"select id, {S.pseudo_prob(3)} as prob from obs where side = 'test'")
def s1_s3_s7_submission_roundtrip(spark, sf_dir):
    """Write a headerless id-ordered submission, read it back (and its id template) with the declared schema."""
    sc = pseudo_scores(observations(spark, sf_dir)).where((F.col("side") == "test") & (F.col("model") == "m3"))
    path = _scratch(spark, "submission")
    IO.write_submission(sc, path)
    sub = IO.read_submission(spark, path)
    template = IO.read_id_template(spark, path)
    return sub.join(template, "id", "inner")


@register("s6_s8_submissions_to_long_and_matrix", ops=["S6", "S8"], sql=W(S.OBS, S.scores("obs", "sc")) +
          "select id, model, prob from sc where side = 'test'")
def s6_s8_submissions_to_long_and_matrix(spark, sf_dir):
    """Several submission files → one long score table; the wide record × model matrix is written
    sorted by difficulty as well."""
    sc = pseudo_scores(observations(spark, sf_dir)).where(F.col("side") == "test")
    long = IO.scores_from_files(spark, _written(sc, "model", PSEUDO_MODELS))
    wide = long.groupBy("id").pivot("model", list(PSEUDO_MODELS)).agg(F.first("prob"))
    IO.write_matrix(wide.withColumn("avg_prob", sum(F.col(m) for m in PSEUDO_MODELS) / len(PSEUDO_MODELS)),
                    _scratch(spark, "matrix"), [F.col("avg_prob").desc(), "id"])
    return long.select("id", "model", "prob")


def _written(scores, by: str, names) -> dict[str, str]:
    """Headerless (id, prob) files of every model, one folder each, written in one job."""
    folder = _scratch(scores.sparkSession, "submissions")
    scores.select("id", "prob", F.col(by).alias("model")).write.partitionBy("model").option("header", "false").csv(folder)
    return {n: f"{folder}/model={n}" for n in names}


FILE_SEEDS = tuple(range(9))
FILES = [f"{m}_s{s}" for m in PSEUDO_MODELS for s in FILE_SEEDS]


@register("x9_x10_score_submission_files", ops=["X9", "X10", "S6", "S7"], doubles=["auc", "n_pos", "n_neg"], sql=W(
    *HOLDOUT_SQL, S.seeded_scores("obs", "ss", FILE_SEEDS),
    """fs as (select ss.model || '_s' || ss.seed as model, ss.prob, h.survived as label, h.confidence from ss join holdout h on ss.id = h.id
  where ss.side = 'test' and h.survived is not null)""",
    """lv as (select model, 'all' as level, label, prob from fs
  union all select model, 'sure', label, prob from fs where confidence in ('unique', 'all_agree')
  union all select model, 'unique', label, prob from fs where confidence = 'unique')""",
) + "select * from " + S.auc_sql("lv", ["model", "level"]) + " t")
def x9_x10_score_submission_files(spark, sf_dir):
    """45 files, one for every model and seed; all scored on {all, sure, unique} labels in one scan of the files."""
    sc = seeded_scores(observations(spark, sf_dir), FILE_SEEDS).where(F.col("side") == "test")
    sc = sc.select("id", "prob", F.concat_ws("_s", "model", F.col("seed").cast("string")).alias("file"))
    return IO.score_files(spark, _written(sc, "file", FILES), holdout_labels(spark, sf_dir), "survived")


@register("s1_s4_s5_header_csv_sources", ops=["S1", "S4", "S5"], doubles=["x1", "x2"], sql=W(*HOLDOUT_SQL) + """
select obs.id, obs.grp, obs.cat, obs.x1, obs.x2, h.survived, h.confidence from obs join holdout h on obs.id = h.id where obs.side = 'test'""")
def s1_s4_s5_header_csv_sources(spark, sf_dir):
    """The test rows and the holdout labels as CSV files with a header (the hand-offs of the table and label
    sources), read with declared schemas and joined by id, never by position."""
    table, labels = _scratch(spark, "table"), _scratch(spark, "labels")
    obs = observations(spark, sf_dir).where(F.col("side") == "test")
    obs.select("id", "grp", "cat", "x1", "x2").write.option("header", "true").csv(table)
    holdout_labels(spark, sf_dir).select("id", "survived", "confidence").write.option("header", "true").csv(labels)
    rows = IO.read_table(spark, table, "id long, grp int, cat string, x1 double, x2 double")
    return rows.join(IO.read_table(spark, labels, "id long, survived int, confidence string"), "id")


@register("s8_matrix_by_difficulty", ops=["S8", "R1"], doubles=["avg_prob"], sql=W(*BASE) + "select rec.id, rec.label, " + ", ".join(
    f"max(case when corr.model = '{m}' then corr.correct end) as {m}" for m in PSEUDO_MODELS) +
    ", any_value(rec.correct_count) as correct_count, any_value(rec.avg_prob) as avg_prob from rec join corr on rec.id = corr.id group by rec.id, rec.label")
def s8_matrix_by_difficulty(spark, sf_dir):
    """The record × model matrix written with a header, the hardest records first, and read back."""
    sc = pseudo_scores(observations(spark, sf_dir)).select("id", "model", "prob")
    corr = correctness(sc, holdout_labels(spark, sf_dir), label="survived")
    wide = corr.groupBy("id").pivot("model", list(PSEUDO_MODELS)).agg(F.first("correct"))
    rec = per_record(corr, list(PSEUDO_MODELS)).select("id", "label", F.col("correct_count").cast("int").alias("correct_count"), "avg_prob")
    out = rec.join(wide, "id").select("id", "label", *PSEUDO_MODELS, "correct_count", "avg_prob")
    path = _scratch(spark, "matrix")
    IO.write_matrix(out, path, ["correct_count", F.col("avg_prob").desc(), "id"])
    return IO.read_table(spark, path, "id long, label int, " + ", ".join(f"{m} int" for m in PSEUDO_MODELS) + ", correct_count int, avg_prob double")


OBS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("grp", T.IntegerType()),
    T.StructField("flag", T.IntegerType()), T.StructField("cat", T.StringType()), T.StructField("x1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()), T.StructField("c1", T.IntegerType()), T.StructField("c2", T.IntegerType()),
    T.StructField("side", T.StringType())])


def _stream_sql() -> str:
    sql = _builder_sql("minimal")
    return sql.replace("select ai.id, ai.eval_fold,", "select * from (select ai.id, ai.eval_fold,", 1) + \
        ") streamed where eval_fold = -1 and id in (select id from obs where side = 'test')"


@register("stream_feature_scoring", ops=["I11", "I3", "S1"], doubles=["x1", "x2", "log_x2", "x2_per_person"], digits=9,
          sql=_stream_sql())
def stream_feature_scoring(spark, sf_dir):
    """Fit the minimal feature model on the training rows (every eval fold), then apply it with
    Structured Streaming to the test rows arriving as parquet files (eval fold -1, stream–static
    joins), drained with an available-now trigger."""
    _, tr, te = split(spark, sf_dir)
    fm = preset("minimal", levels=CATS, classes=GRPS).fit(tr, "fold", K)
    src = _scratch(spark, "stream-src")
    te.select(*[f.name for f in OBS_SCHEMA.fields]).repartition(4).write.mode("overwrite").parquet(src)
    out = run_to_table(feature_stream(spark, src, OBS_SCHEMA, fm), _scratch(spark, "stream-out"), _scratch(spark, "stream-ckpt"))
    return out
