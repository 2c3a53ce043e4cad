"""Readers for the provided parquet tables and the observation adapter built from them.

The adapter ``observations`` turns the order/customer star schema into one binary-classification
table (id, label, a class-like group, a binary flag, a nullable category, two nullable numerics, two
small counts, a train/test side). Nulls and the split are injected with md5-derived uniforms so the
same rows come out of DuckDB for the oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.columns import hash_int24, hash_uniform

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# fixed values of the adapter (mirrored in foldwise/catalog/sql.py)
NULL_RATE_X1 = 0.2
NULL_RATE_CAT = 0.02
TRAIN_SHARE = 0.5
PSEUDO_MODELS = ("m1", "m2", "m3", "m4", "m5")
PSEUDO_SKILL = 8  # score points added per model index for positives


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_customer(spark: SparkSession, sf_dir: str, extra=()) -> DataFrame:
    """orders ⋈ customer ⋈ nation with only the columns used (pruned at the scans). orders ⋈
    customer is fact ⋈ large dimension: left to the planner (sort-merge at scale, broadcast when the
    scan statistics say customer is small); nation is a 25-row scan."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
                                               *[x for x in extra if x.startswith("c_")])
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def _obs_columns():
    oid = F.col("o_orderkey")
    return [
        oid.alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.col("n_regionkey") + 1).cast("int").alias("grp"),
        (F.col("o_orderpriority") <= "2-HIGH").cast("int").alias("flag"),
        F.when(hash_uniform("cat", oid) >= NULL_RATE_CAT, F.col("c_mktsegment")).alias("cat"),
        F.when(hash_uniform("x1", oid) >= NULL_RATE_X1, F.col("c_acctbal") / 100.0).alias("x1"),
        (F.col("o_totalprice") / 1000.0).alias("x2"),
        (F.col("o_custkey") % 4).cast("int").alias("c1"),
        (F.col("o_custkey") % 3).cast("int").alias("c2"),
        F.when(hash_uniform("side", oid) < TRAIN_SHARE, F.lit("train")).otherwise(F.lit("test")).alias("side"),
    ]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs``: one row per order (id, label, grp, flag, cat, x1, x2, c1, c2, side)."""
    return _order_customer(spark, sf_dir).select(*_obs_columns())


def pseudo_score_expr(k: int, id_col="id", label_col="label"):
    """Score of pseudo-model ``k`` (1-based): a 2-decimal hash score, shifted up for positives."""
    u100 = (hash_int24(f"m{k}", id_col) / 167773).cast("long")
    return F.least(u100 + F.lit(PSEUDO_SKILL * k) * F.col(label_col), F.lit(99)) / 100.0


def pseudo_scores(obs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long score table (id, label, side, model, prob, and columns to ``keep``): five pseudo-models of growing skill."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), pseudo_score_expr(i + 1).alias("prob"))
                     for i, m in enumerate(PSEUDO_MODELS)])
    return obs.select("id", "label", "side", *keep, F.explode(rows).alias("s")).select(
        "id", "label", "side", "s.model", "s.prob", *keep)


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second, class-imbalanced target: document quality joined to document size/lang."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return lab.join(d, "doc_id")


# fixed values: honorifics written into registry names (one drawn per row by hash) and the share
# of names written without one
REGISTRY_TITLES = ("Mr", "Mrs", "Miss", "Master", "Dr", "Rev", "Col")
REGISTRY_NO_TITLE = 0.05
REGISTRY_NO_FARE = 0.03
REGISTRY_NO_CABIN = 0.7


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wider registry of the same population (every order), with free-text columns: a name with
    an honorific, a shared ticket (the customer), a cabin code (segment initial + number, often
    missing), a fare that is sometimes missing, and the label. ``ext_row`` is its stable row order."""
    j = _order_customer(spark, sf_dir, extra=("c_name",)).select(
        *_obs_columns(), "o_custkey", "c_name", "c_mktsegment")
    rid = F.col("id")
    titles = F.array(*[F.lit(t) for t in REGISTRY_TITLES])
    title = F.element_at(titles, (F.floor(hash_uniform("title", rid) * len(REGISTRY_TITLES)) + 1).cast("int"))
    name = F.when(hash_uniform("notitle", rid) < REGISTRY_NO_TITLE, F.col("c_name")).otherwise(
        F.concat(F.col("c_name"), F.lit(", "), title, F.lit(". Holder")))
    cabin = F.when(hash_uniform("cabin", rid) >= REGISTRY_NO_CABIN,
                   F.concat(F.substring("c_mktsegment", 1, 1), (F.col("o_custkey") % 100).cast("string")))
    return j.select(
        rid.alias("ext_row"), "label", "grp", "flag", "c1", "c2", "cat", "x1",
        F.when(hash_uniform("rfare", rid) >= REGISTRY_NO_FARE, F.col("x2")).alias("x2"),
        name.alias("name"), F.col("o_custkey").cast("string").alias("ticket"), cabin.alias("cabin"))


def seeded_scores(obs: DataFrame, seeds=(0, 1, 2)) -> DataFrame:
    """Pseudo-model scores repeated over seeds (a different hash stream per seed): (id, label,
    side, seed, model, prob) — the multi-seed score table."""
    rows = []
    for s in seeds:
        for i, m in enumerate(PSEUDO_MODELS):
            k = i + 1
            u100 = (hash_int24(f"m{k}s{s}", "id") / 167773).cast("long")
            p = F.least(u100 + F.lit(PSEUDO_SKILL * k) * F.col("label"), F.lit(99)) / 100.0
            rows.append(F.struct(F.lit(s).alias("seed"), F.lit(m).alias("model"), p.alias("prob")))
    return obs.select("id", "label", "side", F.explode(F.array(*rows)).alias("s")).select(
        "id", "label", "side", "s.seed", "s.model", "s.prob")


def with_signal_label(obs: DataFrame, out: str = "label") -> DataFrame:
    """Replace the label by one the features can predict (for the model-based operators): a noisy
    threshold on (x2, flag, c1) — the provided status label carries no signal in these columns."""
    z = (F.coalesce(F.col("x2"), F.lit(0.0)) / 100.0 + 1.5 * F.col("flag") - 0.5 * F.col("c1")
         + 3.0 * hash_uniform("ys", "id"))
    return obs.withColumn(out, (z > 3.0).cast("int"))
