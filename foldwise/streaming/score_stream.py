"""Applying a fitted feature model to a stream (Structured Streaming).

A fitted ``FeatureModel`` is stateless: every statistic is a small static table, so scoring new
rows is a stream–static join per statistic. New rows use the full-train statistics (eval fold -1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.foldstats import EVAL


def feature_stream(spark: SparkSession, source_dir: str, schema, feature_model, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of feature rows for files arriving in ``source_dir``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source_dir).withColumn(EVAL, F.lit(-1))
    return feature_model.transform(rows)


def run_to_table(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> DataFrame:
    """Drain everything available into Parquet files in ``out_dir`` (append mode) and return them as a
    batch DataFrame; the checkpoint keeps the offsets, so a restart resumes instead of re-reading."""
    q = (stream.writeStream.format("parquet").outputMode("append").option("path", out_dir)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out_dir)
