"""Reading inputs and cutting lineage for the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.plans.session import ensure_checkpoint_dir

#: Rows of 8-byte keys that may be broadcast (16 MB); beyond it joins stay shuffled.
BROADCAST_ROWS = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder below the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


#: At most so many keys are hot, each with more than this share of all rows.
HOT = 1000
#: Shuffle files of a write go when it has ended; nothing reads them again.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends there, and a
    lost executor costs only the tasks it was running.  ``discard`` deletes the folder again."""
    spark = df.sparkSession
    path = shared_folder(spark, what)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._folder = path
    return kept


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with more underscores before it, as no column of ``df`` is called (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def discard(*kept: DataFrame) -> None:
    """Delete folders that ``keep`` wrote and that no later step reads."""
    for df in kept:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots as double underscores) that hold for the writes made inside."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def join_hot(big: DataFrame, small: DataFrame, on: str, weight: str) -> DataFrame:
    """``big`` left join ``small`` (one row a key; ``weight``: the rows of ``big`` it meets, dropped).

    Keys with over 1/``HOT`` of all rows, at most ``HOT`` of them, are broadcast; the rest is shuffled, where
    no key holds more than that share.  Null keys meet nothing."""
    total = small.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT > total
    few = F.broadcast(small.where(hot).drop(weight))
    rest = big.join(few.select(on), on, "left_anti").join(small.where(~hot).drop(weight), on, "left")
    return big.join(few, on).unionByName(rest)


def semi(big: DataFrame, keys: DataFrame, on: list[str], n_keys: int) -> DataFrame:
    """Rows of ``big`` whose key is in ``keys`` (``n_keys`` distinct rows, counted by the caller):
    the keys are broadcast up to ``BROADCAST_ROWS``, else both sides are shuffled."""
    return big.join(F.broadcast(keys) if n_keys <= BROADCAST_ROWS else keys, on, "left_semi")


def held_out(doc_id) -> Column:
    """The fold that no label is learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
