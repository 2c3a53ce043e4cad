"""CSV sources and sinks of the reference's file hand-offs (declared schemas, never
inferred; rows are matched by id, never by position)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.features import confidence_filter
from foldwise.operators.metrics import auc
from foldwise.plans.joins import join_on_keys

SUBMISSION_SCHEMA = "id long, prob double"


def read_table(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A CSV with a header and a declared schema (parquet when the path ends so)."""
    if path.endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(schema).option("header", str(header).lower()).csv(path)


def read_id_template(spark: SparkSession, path: str) -> DataFrame:
    """The headerless id template (the first line is data, not a header)."""
    return spark.read.schema(SUBMISSION_SCHEMA).option("header", "false").csv(path).select("id")


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """S3: a headerless (id, prob) file."""
    return spark.read.schema(SUBMISSION_SCHEMA).option("header", "false").csv(path)


def write_submission(df: DataFrame, path: str, id_col: str = "id", prob: str = "prob") -> None:
    """Headerless (id, prob), globally ordered by id (a range-partitioned sort: each output
    part holds a contiguous id range)."""
    (df.select(F.col(id_col).cast("long").alias("id"), F.col(prob).cast("double").alias("prob"))
     .orderBy("id").write.mode("overwrite").option("header", "false").csv(path))


def scores_from_files(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """Many submission files (or folders of part files) → one long score table (id, model, prob), in one
    scan of all paths: a row's model is read off its file's path. An empty mapping gives an empty table."""
    if not files:
        return spark.createDataFrame([], "id long, model string, prob double")
    name_of = {_qualified(spark, path): name for name, path in files.items()}
    names = F.create_map(*[F.lit(x) for kv in name_of.items() for x in kv])
    file = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    rows = spark.read.schema(SUBMISSION_SCHEMA).option("header", "false").csv(list(files.values()))
    return rows.select("id", F.coalesce(names[file], names[F.regexp_replace(file, "/[^/]*$", "")], file).alias("model"), "prob")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark reports it for the rows read from it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()
    return re.sub("^file:/+", "file:/", uri)


def score_files(spark: SparkSession, files: Mapping[str, str], labels: DataFrame, label: str = "label",
                confidence: str = "confidence", levels: Sequence[str] = ("all", "sure", "unique")) -> DataFrame:
    """AUC of every submission file on the labelled rows of every confidence level — one scan of
    the files, one join with the labels, one grouped AUC. Rows without a label count in no level."""
    known = labels.where(F.col(label).isNotNull()).select("id", F.col(label).alias("label"), F.col(confidence).alias("confidence"))
    scored = join_on_keys(scores_from_files(spark, files), known, ["id"], "inner")
    which = F.filter(F.array(*[F.when(confidence_filter("confidence", lv), F.lit(lv)) for lv in levels]), lambda x: x.isNotNull())
    return auc(scored.withColumn("level", F.explode(which)), "label", "prob", ["model", "level"])


def write_matrix(df: DataFrame, path: str, order_cols) -> None:
    """A wide record × model table, sorted (e.g. by difficulty), with a header."""
    df.orderBy(*order_cols).write.mode("overwrite").option("header", "true").csv(path)
