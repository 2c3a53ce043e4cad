"""Phrase collocations by top-order marginalisation: windows of the longest order are counted once, and
Spark's ROLLUP sums them to every shorter order.

A text, A-Z lower-cased, is cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words ``[^\\x20\\x09]+``.
At every word stands one window: the word and the ``ORDER - 1`` words that follow it in its piece, padded
with 0 past the end.  A phrase of k words occurs where a window begins with it, so the counts of windows,
rolled up to (lang, w1 ... wk), are the counts of all phrases.

A window is padded earlier, where no frequent phrase can reach: from the first word on that is too rare, or
ends too rare a run of up to ``RUNS`` words; a window of one word isn't counted (the pass over words has
counted it).  Rare words and runs are found by passes whose counts only fill bit tables of a fixed size
(``BITS``): a table may take a rare run for a frequent one, never the reverse, so it saves work and changes
no count.  Words go as 64-bit hashes; the first pass sees whether two words of the corpus share one, and
takes another seed if so.

``phrases`` gives the counts, ``collocations`` the ranked report: of every cut of a phrase the lowest score
a * n / (l * r); a phrase goes if some longer frequent phrase holds all its occurrences.

A null lang counts as ``und``; null, empty and blank texts have no words; rows that repeat count again; an
empty table gives no rows; other columns are not looked at.  Texts are whole: a task holds one text, or
texts of about ``CHUNK_BYTES``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.hashing import chunks, mix
from foldwise.llm.tables import discard, keep, settings

#: Words of the longest phrase, least count, rows of the report for a language.
ORDER, LEAST, TOP = 5, 100, 2000
#: Words of the longest run that is looked up in a table; bits of a table; rows a task counts before it lets go of them.
RUNS, BITS, COUNTED = 2, 1 << 25, 1 << 20
CHUNK_BYTES = 1 << 20
#: Rows that a Python worker gets at once.
ROWS = 1000
UNKNOWN = "und"

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] += 32
_CLASS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 10
_CLASS[9] = 32


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, piece number of each word) of a chunk's texts, in reading order."""
    raw = _CLASS[raw]
    gap = (raw == 10) | (raw == 32)
    first = np.zeros(len(raw), bool)  # of a text
    first[offsets[:-1][offsets[:-1] < len(raw)]] = True
    word = ~gap
    starts = np.flatnonzero(word & (first | np.concatenate([[True], gap[:-1]])[: len(raw)]))
    piece = np.cumsum((raw == 10) | first)[starts]
    kept = raw[word]
    at = np.append((np.cumsum(word) - word)[starts], len(kept)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(kept)]), piece


def _hashes(words: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of every word, hash of every code, distinct words); no hash is 0."""
    coded = words.dictionary_encode()
    salt = seed.to_bytes(8, "little")
    h = [int.from_bytes(hashlib.blake2b(w, digest_size=8, salt=salt).digest(), "little") or 1 for w in coded.dictionary.to_pylist()]
    return coded.indices.to_numpy(), np.array(h, np.uint64), coded.dictionary


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for lang in table["lang"].unique().to_pylist():
            part = table.filter(pa.compute.equal(table["lang"], lang)).combine_chunks()
            for one in part.to_batches():
                for _, raw, offsets in chunks(one, "text", CHUNK_BYTES):
                    words, piece = tokens(raw, offsets)
                    if len(words):
                        yield lang, words, piece
        pa.default_memory_pool().release_unused()  # two workers share an executor's memory


def _positions(values: np.ndarray) -> list[np.ndarray]:
    """Two places of a value in a table."""
    values = mix(values)
    return [(values % np.uint64(BITS)).astype(np.int64), (mix(values + np.uint64(1)) % np.uint64(BITS)).astype(np.int64)]


def _salted(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _short(runs: np.ndarray) -> np.ndarray:
    """The upper half of the hashes: runs that share it are counted together, which can only make them look frequent."""
    return runs >> np.uint64(32)


class _Counter:
    """Counts of 64-bit values, given out when it holds ``COUNTED``."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(np.unique(values, return_counts=True))
        self.size += len(self.held[-1][0])
        if self.size >= COUNTED:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            values, back = np.unique(np.concatenate([v for v, _ in self.held]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n for _, n in self.held])).astype(np.int64)
            yield from pa.table({"run": values.view(np.int64), "n": n}).to_batches(100_000)
        self.held, self.size = [], 0


def _table(frequent: DataFrame) -> np.ndarray:
    """A bit table of ``BITS`` bits from a column of values, salted by a column lang if there is one: at most BITS / 64
    rows reach the driver."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if b.num_columns > 1:
                lang = b.column(1).dictionary_encode()
                salts = np.array([_salted(x) for x in lang.dictionary.to_pylist()], np.uint64)
                values = values ^ salts[lang.indices.to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_positions(values)))], ["at"])

    at = frequent.mapInArrow(places, "at long")
    words = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")).toArrow()
    table = np.zeros(BITS // 64, np.uint64)
    table[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return table


def _marked(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    one, two = _positions(values)
    return (table[one >> 6] >> (one & 63).astype(np.uint64)) & (table[two >> 6] >> (two & 63).astype(np.uint64)) & np.uint64(1) == 1


def vocabulary(docs: DataFrame, seed: int, least: int) -> DataFrame:
    """(lang, h, word, last, n) of words that occur ``least`` times, of words that share a hash
    (word <> last), and with h = 0 of the number of words of each language.  Kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        names = ["lang", "h", "word"]

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])

        for lang, words, _ in _by_lang(batches):
            code, h, known = _hashes(words, seed)
            held.append(pa.table({"lang": [lang] * (len(h) + 1), "h": np.append(h, np.uint64(0)).view(np.int64),
                                  "word": pa.concat_arrays([known.cast(pa.binary()), pa.array([b""])]), "n": np.append(np.bincount(code, minlength=len(h)), len(code))}))
            size += len(h)
            if size >= COUNTED // 2:
                held = [summed()]
                size = len(held[0])
                if size >= COUNTED // 4:
                    yield from held[0].to_batches(100_000)
                    held, size = [], 0
        if held:
            yield from summed().to_batches(100_000)

    counted = docs.mapInArrow(run, "lang string, h long, word binary, n long").groupBy("lang", "h")
    counted = counted.agg(F.min("word").alias("word"), F.max("word").alias("last"), F.sum("n").alias("n"))
    return keep(counted.where((F.col("n") >= least) | (F.col("h") == 0) | (F.col("word") != F.col("last"))), "words")


class _Runs:
    """Which words of a chunk, and runs of 2 to ``len(tables)`` words from each on, the tables know."""

    def __init__(self, lang: str, words: pa.Array, piece: np.ndarray, seed: int, tables: list[np.ndarray]):
        self.code, self.h, _ = _hashes(words, seed)
        self.salted = self.h ^ _salted(lang)
        single = _marked(tables[0], self.salted)[self.code]
        self.same = piece[:-1] == piece[1:]  # as the next word's
        self.first = mix(self.salted)
        #: starts of the runs of each length that are known, and the runs' hashes
        self.starts, self.hashes = [np.flatnonzero(single)], [self.first[self.code[np.flatnonzero(single)]]]
        for table in tables[1:]:
            at, run = self.longer()
            ok = _marked(table, _short(run))
            self.starts.append(at[ok])
            self.hashes.append(run[ok])

    def longer(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the runs, one word longer than the longest looked up, both of whose parts are known."""
        k, at = len(self.starts), self.starts[-1]
        known = np.zeros(len(self.code) + 1, bool)
        known[at] = True
        ok = known[at + 1] & np.append(self.same, False)[at + k - 1]
        at, run = at[ok], self.hashes[-1][ok]
        return at, mix(run + self.h[self.code[at + k]])


def phrases(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = ORDER, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, p, f) of all phrases of 1 to ``order`` words that occur ``least`` times, p their word hashes (empty: f
    is the number of all words of lang), and the words (lang, h, word)."""
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(ROWS)):  # texts are long rows
        return _phrases(docs, lang, text, order, least)


def _phrases(docs: DataFrame, lang: str, text: str, order: int, least: int) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    spark, names = docs.sparkSession, [f"w{i}" for i in range(1, order + 1)]
    seed = 0
    while True:
        known = vocabulary(docs, seed, least)
        if known.where("word <> last").isEmpty():
            break
        discard(known)
        seed += 1
    tables = [spark.sparkContext.broadcast(_table(known.where("h <> 0").select("h", "lang")))]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for lang_, words, piece in _by_lang(batches):
            yield from counter.add(_short(_Runs(lang_, words, piece, seed, [t.value for t in tables]).longer()[1]))
        yield from counter.flush()

    while len(tables) < min(RUNS, order):
        counted = docs.mapInArrow(runs, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        tables.append(spark.sparkContext.broadcast(_table(counted.select("run"))))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang_, words, piece in _by_lang(batches):
            found = _Runs(lang_, words, piece, seed, [t.value for t in tables])
            code, h = found.code, found.h
            size = np.zeros(len(code) + order, np.int8)  # words of the longest known run from here on
            for k, at in enumerate(found.starts):
                size[at] = k + 1
            at = np.flatnonzero(size[: len(code)] > 1)
            columns, on = [h[code[at]]], np.ones(len(at), bool)
            for j in range(1, order):
                k = min(j + 1, len(tables))  # the run that ends with word j
                on = on & (size[at + j + 1 - k] >= k)
                lead = np.zeros(len(at), np.uint64)
                lead[on] = h[code[at[on] + j]]
                columns.append(lead)
            lang_column = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(at), np.int32)), pa.array([lang_])).cast(pa.string())
            yield from pa.table([lang_column, *(pa.array(c.view(np.int64)) for c in columns)], ["lang", *names]).to_batches(100_000)

    longest = docs.mapInArrow(windows, "lang string, " + ", ".join(f"{w} long" for w in names))
    longest = longest.groupBy("lang", *names).agg(F.count("*").alias("n"))
    rolled = longest.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # 2^j - 1 of the grouping columns are rolled up: j of them, so order - j words are left
    left = F.lit(order) - F.round(F.log2(F.col("g") + 1)).cast("int")
    # single words have been counted, also where no window begins
    rolled = rolled.where(F.col("g") + 1 < 1 << order - 1).select("lang", F.slice(F.array(*names), F.lit(1), left).alias("p"), "f")
    single = known.select("lang", F.when(F.col("h") == 0, F.array().cast("array<long>")).otherwise(F.array("h")).alias("p"), F.col("n").alias("f"))
    counts = keep(rolled.where((F.col("f") >= least) & ~F.array_contains("p", F.lit(0).cast("long"))).unionByName(single), "phrases")
    return counts, known.where("h <> 0").select("lang", "h", "word")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = ORDER, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    counts, words = phrases(docs, lang, text, order, least)
    total = counts.where(F.size("p") == 0).select("lang", F.col("f").alias("n"))
    of = counts.where(F.size("p") > 0)
    candidates = of.where(F.size("p") > 1).withColumnRenamed("f", "a")
    cut = candidates.select("lang", "p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cut = cut.select("*", F.slice("p", F.lit(1), F.col("k")).alias("x"), F.slice("p", F.col("k") + 1, F.size("p") - F.col("k")).alias("y"))
    cut = cut.join(of.select("lang", F.col("p").alias("x"), F.col("f").alias("l")), ["lang", "x"]).join(of.select("lang", F.col("p").alias("y"), F.col("f").alias("r")), ["lang", "y"])
    cut = cut.join(F.broadcast(total) if total.count() <= 10_000 else total, "lang")
    # the quotient of whole decimals, rounded down exactly
    score = F.expr("cast(1000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(n as decimal(38,0)) div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    scored = cut.withColumn("score", score).groupBy("lang", "p", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    k = F.size("p")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), k - 1), lambda m: F.transform(F.sequence(F.lit(1), k - m + 1), lambda i: F.slice("p", i, m))))
    held = candidates.where(k > 2).select("lang", "a", F.explode(inner).alias("p")).groupBy("lang", "p").agg(F.max("a").alias("most"))
    stay = scored.join(held, ["lang", "p"], "left").where("most is null or 100 * most < 100 * a")
    spelt = stay.select("lang", "p", F.posexplode("p").alias("i", "h")).join(words, ["lang", "h"])
    spelt = spelt.groupBy("lang", "p").agg(F.array_sort(F.collect_list(F.struct("i", F.col("word").cast("string").alias("word")))).alias("s"))
    named = stay.join(spelt, ["lang", "p"]).select("lang", F.array_join(F.transform("s", lambda x: x.word), " ").alias("phrase"), "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").cast("long").alias("score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
