"""Language identification with hyperdimensional profiles.

Every letter has a random +-1 vector, drawn from its code point.  A letter trigram is bound as the
product of its letters' vectors, rotated by two, one and no places; a text is the bundle (sum) of its
trigrams.  A language's prototype is the bundle of its training texts.  A text goes to the language
whose prototype has the largest cosine with it; that cosine, cut at 0, is the score.

Texts are lower-cased; runs of other characters than letters count as one blank, and so do the ends.
Null texts and texts without a letter get ``und`` with score 0.  Ties go to the language first in
alphabetical order.  Without any training text all texts get ``und``.  Repeated rows give repeated
results; extra columns are kept.  A prototype sums whole numbers, so it doesn't depend on the order of
the rows, and it has ``DIMENSIONS`` entries a language, whatever the corpus holds.  A task holds the bundles
of ``TEXTS`` texts and the vectors of 2,048 trigrams, however many different letters there are.  The cosine of a
text with a prototype that shares no trigram with it is noise, of deviation ``NOISE``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.hashing import chunks

DIMENSIONS = 1024
#: Bytes of text and number of texts that are bundled at once; cells of a block of counts.
CHUNK, TEXTS, CELLS = 1 << 19, 1024, 1 << 21
UNDETERMINED = "und"
NOISE = DIMENSIONS**-0.5


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])


@lru_cache(1 << 15)
def _letter(code: int) -> np.ndarray:
    """The vector of a letter; 0 is the blank."""
    return np.random.RandomState(0x5EED ^ code).randint(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code, text index) of every trigram with a letter in it."""
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    symbol = np.where(_letters()[points], points, 0).astype(np.int64)
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0) | (owner[1:] != owner[:-1])
    symbol, owner = symbol[keep], owner[keep]
    if len(symbol) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = owner[2:] == owner[:-2]
    return (symbol[:-2] << 42 | symbol[1:-1] << 21 | symbol[2:])[inside], owner[2:][inside]


def bound(codes: np.ndarray) -> np.ndarray:
    """The vector of each trigram, one a row."""
    places = [codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF]
    out = None
    for turn, place in zip((2, 1, 0), places):
        which, at = np.unique(place, return_inverse=True)
        rows = np.roll(np.stack([_letter(int(c)) for c in which]), turn, axis=1)[at]
        out = rows if out is None else out * rows
    return out.astype(np.float32)


def bundles(texts: list[str], groups: np.ndarray, n_groups: int) -> np.ndarray:
    """The bundle of each group of texts: counts times vectors, some trigrams at a time, so that neither the
    vectors of all trigrams nor the counts of all groups are held at once."""
    out = np.zeros((n_groups, DIMENSIONS), np.float32)
    codes, owner = trigrams(texts)
    codes, at = np.unique(codes, return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], groups[owner[order]]
    step = int(max(64, min(2048, CELLS // max(n_groups, 1))))
    for low in range(0, len(codes), step):
        block = codes[low : low + step]
        here = slice(*np.searchsorted(at, (low, low + len(block))))
        counts = np.bincount(owner[here] * len(block) + at[here] - low, minlength=n_groups * len(block))
        out += counts.reshape(n_groups, len(block)).astype(np.float32) @ bound(block)
    return out


def fit(docs: DataFrame, text: str = "text", label: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes of the labels of ``docs``; rows without label or text teach nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, _, _ in chunks(batch, "text", CHUNK):
                labels = np.array(part.column(1).to_pylist(), object)
                texts = [t or "" for t in part.column(0).to_pylist()]
                for low in range(0, len(texts), TEXTS):
                    names, groups = np.unique(labels[low : low + TEXTS].astype(str), return_inverse=True)
                    for name, v in zip(names, bundles(texts[low : low + TEXTS], groups, len(names))):
                        sums[name] = sums.get(name, 0) + v.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "bundle"])

    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang"))
    parts = rows.mapInArrow(run, "lang string, bundle array<double>")
    total = parts.select("lang", F.posexplode("bundle")).groupBy("lang", "pos").agg(F.sum("col").alias("x")).collect()  # languages x DIMENSIONS
    out: dict[str, np.ndarray] = {}
    for lang, pos, x in total:
        out.setdefault(lang, np.zeros(DIMENSIONS))[pos] = x
    return {k: v / n for k, v in sorted(out.items()) if (n := np.linalg.norm(v)) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with ``lang`` and ``score`` added, columns of these names replaced."""
    names = [*prototypes, UNDETERMINED]
    matrix = np.stack([*prototypes.values()]).astype(np.float32).T if prototypes else None
    rest = [c for c in docs.columns if c not in (lang, score)]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(lang, T.StringType(), False), T.StructField(score, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in chunks(batch, text, CHUNK):
                texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                best, cosine = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
                if matrix is not None:
                    for low in range(0, len(texts), TEXTS):
                        some = slice(low, min(low + TEXTS, len(texts)))
                        vectors = bundles(texts[some], np.arange(some.stop - low), some.stop - low)
                        norm = np.linalg.norm(vectors, axis=1)
                        near = vectors @ matrix / np.maximum(norm, 1e-9)[:, None]
                        best[some] = np.where(norm > 0, near.argmax(1), best[some])
                        cosine[some] = np.where(norm > 0, np.clip(near.max(1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in rest), pa.array([names[i] for i in best]), pa.array(cosine.astype(np.float64))],
                    [*rest, lang, score])

    return docs.select(*rest).mapInArrow(run, schema)
