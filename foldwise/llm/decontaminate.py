"""Benchmark decontamination by template windows.

Texts become templates: numbers, units after a number, and capitalised words within a sentence turn into
typed placeholders, all other words into lower case, punctuation goes.  Every run of ``window`` template
words is hashed; documents' windows are joined with the items' (an item's windows with fewer than
``window // 2`` plain words match too much and are left out).  Windows of one document and item that lie
on the same diagonal belong to one passage.  A document leaks an item if a diagonal holds at least
``share`` of the item's windows and the slots agree: in the passage's windows, one value of an item's slot always
meets one value of the document's, and the other way round.  So a question with other numbers or names is
caught, and a text of the same form whose slots don't correspond is not.

DataFrame functions only.  Null and empty texts and items with fewer than ``window`` template words (or
without a window that counts) match nothing; repeated rows give repeated results; of several diagonals
whose slots agree the one with most windows counts, then the earliest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.tables import BROADCAST_ROWS, fresh, keep, semi

WINDOW, SHARE = 8, 0.5
#: Units of measure and money.
UNITS = ("km kms kilometer kilometers kilometre kilometres m meter meters metre metres cm mm mile miles foot feet ft inch inches yard yards "
         "kg kgs kilogram kilograms g gram grams mg lb lbs pound pounds ounce ounces oz ton tons tonne tonnes l liter liters litre litres ml gallon gallons "
         "s sec second seconds min minute minutes h hour hours day days week weeks month months year years percent "
         "dollar dollars euro euros cent cents usd eur gbp mph kmh degrees celsius fahrenheit").split()
_NAME = r"\p{Lu}(?<=[^\s.!?:;\"“(]\h\p{Lu})\p{Ll}+(?!\p{L})"
_NUMBER = r"[$€£]?(?<![\p{L}\p{N}][$€£]?)\p{N}(?:[\p{N}.,:/]*\p{N})?(?:(?:st|nd|rd|th)(?!\p{L})|%)?"
_UNIT = r"(<n[^>]*>)\s*(" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?!\p{L})"
_TOKEN = r"<[nup][^>]*>|[\p{L}\p{M}]+"


def template(text: Column, values: bool = False) -> Column:
    """The template words of ``text``: plain words, ``<n>``, ``<u>``, ``<p>``; with ``values`` the
    placeholders carry what they stand for, as in ``<n=12>``."""
    def slot(kind: str, group: str) -> str:
        return f" <{kind}={group}> " if values else f" <{kind}> "

    t = F.translate(F.coalesce(text, F.lit("")), "<>", "  ")
    t = F.lower(F.regexp_replace(t, _NAME, slot("p", "$0")))
    t = F.regexp_replace(t, _NUMBER, slot("n", "$0"))
    t = F.regexp_replace(t, _UNIT, "$1" + slot("u", "$2"))
    return F.regexp_extract_all(t, F.lit(_TOKEN), F.lit(0))


def windows(words: Column, window: int) -> Column:
    """Array of (at, hash) of every run of ``window`` words."""
    n = F.size(words) - window
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(F.slice(words, i + 1, window))))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
          window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(``key``, _row, item_id, at, windows, item_windows, slots, changed): a row for each document and
    item it leaks; ``_row`` is a hash of key and text, ``at`` the template word the passage begins with."""
    named = items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("_t"))
    runs = (named.select("item_id", template(F.col("_t")).alias("w")).select("item_id", "w", F.posexplode(windows(F.col("w"), window)).alias("p", "h"))
            .where(F.size(F.filter(F.slice("w", F.col("p") + 1, window), lambda x: ~x.startswith("<"))) >= window // 2).select("item_id", "p", "h").distinct())
    runs = keep(runs, "windows")
    n = runs.count()
    totals = runs.groupBy("item_id").agg(F.countDistinct("p").alias("item_windows"))

    row = F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("_row")
    seen = docs.select(row, template(F.col(text)).alias("w")).select("_row", F.posexplode(windows(F.col("w"), window)).alias("q", "h"))
    hits = seen.join(F.broadcast(runs) if n <= BROADCAST_ROWS else runs, "h").select("_row", "item_id", "p", (F.col("q") - F.col("p")).alias("at")).distinct()
    lines = hits.groupBy("_row", "item_id", "at").agg(F.count("*").alias("windows"), F.collect_list("p").alias("met")).join(totals, "item_id")
    lines = keep(lines.where(F.col("windows") >= F.col("item_windows") * share), "passages")

    found = lines.select("_row").distinct()
    texts = semi(docs.select(F.col(key), row, F.col(text).alias("_text")), found, ["_row"], found.count())
    texts = texts.select(key, "_row", template(F.col("_text"), True).alias("d"))
    pairs = lines.join(texts, "_row").join(named.groupBy("item_id").agg(F.min("_t").alias("_t")).select("item_id", template(F.col("_t"), True).alias("i")), "item_id")
    # the aligned words; a passage may begin before the document does or end after it
    pairs = pairs.withColumn("from", F.greatest(-F.col("at"), F.lit(0))).withColumn("n", F.least(F.size("i") - F.col("from"), F.size("d") - F.col("at") - F.col("from")))
    both = F.arrays_zip(F.slice("i", F.col("from") + 1, F.col("n")).alias("i"), F.slice("d", F.col("at") + F.col("from") + 1, F.col("n")).alias("d"))
    # only words of matched windows belong to the passage
    both = F.filter(both, lambda x, k: F.exists("met", lambda p: (p <= k + F.col("from")) & (k + F.col("from") < p + window)))
    slots = F.array_distinct(F.filter(both, lambda x: x["i"].startswith("<") & (F.substring(x["i"], 1, 2) == F.substring(x["d"], 1, 2))))
    pairs = pairs.withColumn("_slots", slots)
    one_to_one = (F.size(F.array_distinct(F.col("_slots.i"))) == F.size("_slots")) & (F.size(F.array_distinct(F.col("_slots.d"))) == F.size("_slots"))
    passed = pairs.where(one_to_one).select(key, "_row", "item_id", "at", "windows", "item_windows", F.size("_slots").alias("slots"),
                                            F.size(F.filter("_slots", lambda x: x["i"] != x["d"])).alias("changed"))
    best = Window.partitionBy("_row", "item_id").orderBy(F.desc("windows"), "at")
    return passed.withColumn("_n", F.rank().over(best)).where("_n = 1").drop("_n")  # rank: repeated rows are equals


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that leak an item."""
    bad = keep(leaks(docs, items, key, text, **options).select("_row").distinct(), "leaks")
    row = fresh(docs, "_row")
    marked, bad = docs.withColumn(row, F.xxhash64(F.col(key).cast("string"), F.col(text))), bad.withColumnRenamed("_row", row)
    return marked.join(F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad, row, "left_anti").select(docs.columns)
