"""The bounded sample of labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.tables import BROADCAST_ROWS


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of about ``rows`` labelled documents at most, chosen by hash of the key; all of them
    where there are fewer.  Null keys, labels and texts are left out; of several labels of one key the
    largest counts."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    n = known.count()
    share = min(1.0, rows / max(n, 1))
    drawn = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) < int(share * (1 << 30))
    known = known.where(drawn)
    picked = docs.where(drawn & F.col(text).isNotNull()).select(key, F.col(text).alias("text"))
    return picked.join(F.broadcast(known) if share * n <= BROADCAST_ROWS else known, key).select("text", "label")
