"""Joins between observation tables, label files and a wider registry.

"First registry row wins" is an aggregation (``min_by`` on the stable row order) before the join,
so a key shared by many registry rows never fans out into all its pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.features import first_letter, title_of
from foldwise.plans.joins import join_on_keys

UNKNOWN = "Unknown"


def key_of_value(c, scale: int = 10) -> Column:
    """Integer key of a value rounded to 1/scale (half-up); null → -1 (J5's missing-fare key)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.floor(x * scale + 0.5).cast("long"), F.lit(-1).cast("long"))


def first_per_key(reg: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """One row per key: the columns of the registry row with the smallest ``order`` (null keys
    form their own group, as in a dictionary keyed by the raw values)."""
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order))
    return reg.groupBy(*keys).agg(best.alias("_first")).select(*keys, "_first.*")


def left_join_first(df: DataFrame, reg: DataFrame, keys: Sequence[str], order: str,
                    cols: Sequence[str], suffix: str = "_ext") -> DataFrame:
    """Left join keeping the first registry match per row; null keys match (pandas merge)."""
    first = first_per_key(reg, keys, order, cols)
    first = first.select(*keys, *[F.col(c).alias(c + suffix) for c in cols])
    return join_on_keys(df, first, list(keys), "left", null_safe=True)


def enrich(df: DataFrame, reg: DataFrame, keys: Sequence[str], fare_col: str, order: str = "ext_row",
           name_col: str = "name", cabin_col: str = "cabin", ticket_col: str = "ticket", also: Sequence[str] = ()) -> DataFrame:
    """Registry lookup on (keys…, rounded fare). The registry gets title (regex on the name),
    deck (first letter of the cabin) and ticket group size; the first registry row per key wins;
    unmatched rows get Unknown / Unknown / 1 and ``matched`` = 0. ``also``: further registry columns of
    that row, null where unmatched."""
    tickets = reg.groupBy(ticket_col).agg(F.count(F.lit(1)).alias("_tgs"))
    r = join_on_keys(reg, tickets, [ticket_col], "left")
    r = r.select(*keys, key_of_value(fare_col).alias("_fare_key"), order,
                 F.coalesce(title_of(name_col), F.lit(UNKNOWN)).alias("title"),
                 F.coalesce(first_letter(cabin_col), F.lit(UNKNOWN)).alias("deck"),
                 F.coalesce(F.col("_tgs"), F.lit(1)).cast("long").alias("ticket_group_size"), *also)
    first = first_per_key(r, [*keys, "_fare_key"], order, ["title", "deck", "ticket_group_size", *also])
    first = first.withColumn("matched", F.lit(1))
    d = df.withColumn("_fare_key", key_of_value(fare_col))
    out = join_on_keys(d, first, [*keys, "_fare_key"], "left")
    return out.select(
        *[c for c in df.columns],
        F.coalesce("title", F.lit(UNKNOWN)).alias("title"),
        F.coalesce("deck", F.lit(UNKNOWN)).alias("deck"),
        F.coalesce("ticket_group_size", F.lit(1).cast("long")).alias("ticket_group_size"),
        F.coalesce("matched", F.lit(0)).alias("matched"), *also)


# fixed values: title codes of the registry flags (unknown and every other title → 6) and the
# titles that count as common; upper decks
TITLE_CODES = {"Mr": 0, "Mrs": 1, "Miss": 2, "Master": 3, "Dr": 4, "Rev": 5, "Unknown": 6}
COMMON_TITLES = ("Mr", "Mrs", "Miss", "Master")
UPPER_DECKS = ("A", "B", "C")


def registry_flags(df: DataFrame) -> DataFrame:
    """Title code, rare title, master flag, has cabin, upper deck, in group, large group; the
    text columns are dropped."""
    pairs = []
    for k, v in TITLE_CODES.items():
        pairs += [F.lit(k), F.lit(v)]
    code = F.coalesce(F.create_map(*pairs)[F.col("title")], F.lit(6))
    return df.select(
        "*", code.alias("title_enc"),
        (~F.col("title").isin(*COMMON_TITLES)).cast("int").alias("rare_title"),
        (F.col("title") == "Master").cast("int").alias("is_master"),
        (F.col("deck") != UNKNOWN).cast("int").alias("has_cabin"),
        F.col("deck").isin(*UPPER_DECKS).cast("int").alias("upper_deck"),
        (F.col("ticket_group_size") > 1).cast("int").alias("in_group"),
        (F.col("ticket_group_size") >= 4).cast("int").alias("large_group"),
    ).drop("title", "deck", "ticket_group_size")


def link_labels(holdout: DataFrame, reg: DataFrame, keys: Sequence[str], label: str = "label",
                id_col: str = "id") -> DataFrame:
    """Label each holdout row from registry candidates sharing all keys (nulls match):
    one candidate → ``unique``; several agreeing → ``all_agree``; disagreeing → ``conflicting``
    with the label left null. Candidates are counted per key, never paired with rows."""
    cand = reg.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_candidates"),
                                  F.count_distinct(F.col(label)).alias("_labels"),
                                  F.min(F.col(label)).alias("_label"))
    j = join_on_keys(holdout.select(id_col, *keys), cand, list(keys), "left", null_safe=True)
    conf = (F.when(F.col("n_candidates").isNull(), F.lit("unmatched"))
            .when(F.col("n_candidates") == 1, F.lit("unique"))
            .when(F.col("_labels") == 1, F.lit("all_agree"))
            .otherwise(F.lit("conflicting")))
    return j.select(id_col, F.when(conf.isin("unique", "all_agree"), F.col("_label")).alias("survived"),
                    conf.alias("confidence"), F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"))
