"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side) and a join of the edges with that one-row-per-node
table, so a node that holds a third of all edges is split like any skewed join.  The edges live in the
shared folder between rounds; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.tables import discard, keep


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    return large


def _small(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = low.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of ``links`` and the smallest node it reaches.

    Links with a null end and links of a node with itself are ignored (such a node is in no row
    unless another link names it); repeated and reversed links count once; an empty table gives no
    rows.  Nodes may be of any ordered type.
    """
    edges = keep(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        before, edges = edges, keep(_small(_stars(edges)), "stars")
        discard(before)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
