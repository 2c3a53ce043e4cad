"""Toxicity: a lexicon learned from labels, matched by Levenshtein automata, scored in context.

Lexicon: words, and stems with several endings, that are far likelier in toxic than in other training
documents; a log-odds weight each.  They form a trie; the automata that accept everything within an
entry's edit distance (1 from five letters on, 2 from nine; stems likewise, and any ending) run over all
entries at once as one automaton on sets of (trie node, edits), made deterministic step by step and
remembered.  A word that leaves every entry's neighbourhood dies after a few letters.

Context: a hit counts its weight, less for every edit, and less again inside quotation marks or next to a
word that reports speech; the densest window of a text counts besides the sum.  A logistic model of these
features, fitted on the sample, gives the score.

Null and empty texts score like a text without hits; ties cannot arise; repeated rows score alike; with
no labels of both kinds the lexicon is empty and every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.sample import labelled

#: Labelled rows that are learned from; the least toxic documents that must hold an entry; the largest lexicon.
SAMPLE_ROWS, LEAST_DOCUMENTS, MAX_ENTRIES = 20_000, 8, 4_000
STEM_LENGTHS = range(4, 11)
WINDOW, QUOTED = 12, 0.3
#: Quotation marks and words that report speech.
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset("said says say quote quoted quoting wrote writes called term word words insult insults slur according".split())
MAX_STATES, MAX_WORDS = 200_000, 400_000
_WORD = re.compile(r"\w+").findall
_SPOT = re.compile(r"\w+").finditer


@dataclass
class Lexicon:
    """Entries: (text, is_stem) -> weight."""

    entries: dict[tuple[str, bool], float] = field(default_factory=dict)


def edits_allowed(entry: str, stem: bool) -> int:
    n = len(entry) - (2 if stem else 0)
    return 2 if n >= 9 else 1 if n >= 5 else 0


class Automaton:
    """The union of the entries' Levenshtein automata, intersected with the trie of the entries."""

    def __init__(self, lexicon: Lexicon):
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[bool, int, float]]] = [[]]
        self.reach = [0]  # the most edits that any entry below a node allows
        for (entry, stem), weight in sorted(lexicon.entries.items()):
            k, node = edits_allowed(entry, stem), 0
            self.reach[0] = max(self.reach[0], k)
            for c in entry:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.child[node][c]
                self.reach[node] = max(self.reach[node], k)
            self.ends[node].append((stem, k, weight))
        self.letters = {c for d in self.child for c in d}
        self.words: dict[str, tuple[float, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.start = self.state({0: 0}, None)

    def state(self, nodes: dict[int, int], found: tuple[float, int] | None) -> int:
        """The id of a set of nodes with the fewest edits to each, skipping letters of entries included."""
        todo = [*nodes.items()]
        while todo:
            node, e = todo.pop()
            if nodes.get(node) == e:
                for below in self.child[node].values():
                    if e < self.reach[below] and nodes.get(below, 99) > e + 1:
                        nodes[below] = e + 1
                        todo.append((below, e + 1))
        for node, e in nodes.items():  # a stem once met stays met
            for stem, k, weight in self.ends[node]:
                if stem and e <= k:
                    found = better(found, (weight, e))
        key = (frozenset(nodes.items()), found)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append((nodes, found))
            self.steps.append({})
        return self.ids[key]

    def step(self, state: int, letter: str) -> int:
        nodes, found = self.sets[state]
        after: dict[int, int] = {}
        for node, e in nodes.items():
            if e < self.reach[node] and after.get(node, 99) > e + 1:
                after[node] = e + 1
            for c, below in self.child[node].items():
                cost = e + (c != letter)
                if cost <= self.reach[below] and after.get(below, 99) > cost:
                    after[below] = cost
        return self.state(after, found)

    def match(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the best entry that ``word`` matches, or None."""
        if len(self.sets) > MAX_STATES:
            self.reset()
        state, steps, letters = self.start, self.steps, self.letters
        for c in word:
            c = c if c in letters else "\0"
            after = steps[state].get(c)
            if after is None:
                after = steps[state][c] = self.step(state, c)
            state = after
            if not self.sets[state][0]:
                break
        nodes, found = self.sets[state]
        for node, e in nodes.items():
            for stem, k, weight in self.ends[node]:
                if not stem and e <= k:
                    found = better(found, (weight, e))
        return found

    def matched(self, word: str) -> tuple[float, int] | None:
        try:
            return self.words[word]
        except KeyError:
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            out = self.words[word] = self.match(word)
            return out


def better(a: tuple[float, int] | None, b: tuple[float, int]) -> tuple[float, int]:
    return b if a is None or (-b[1], b[0]) > (-a[1], a[0]) else a


def hits(automaton: Automaton, text: str) -> list[tuple[int, int, int, float, int, bool]]:
    """(word number, begin, end, weight, edits, quoted) of every word of ``text`` that the lexicon matches."""
    lowered = text.lower()
    matched = automaton.matched
    toxic = {w for w in set(_WORD(lowered)) if matched(w)}
    if not toxic:
        return []
    out = []
    spots = [*_SPOT(lowered)]
    marks = [i for i, c in enumerate(lowered) if c in QUOTES]
    for i, m in enumerate(spots):
        if m[0] in toxic:
            weight, edits = automaton.matched(m[0])
            near = {s[0] for s in spots[max(0, i - 4) : i + 5]}
            left = bisect(marks, m.start())
            opened = left > 0 and m.start() - marks[left - 1] <= 80
            closed = left < len(marks) and marks[left] - m.end() <= 80
            out.append((i, m.start(), m.end(), weight, edits, bool(opened and closed) or bool(near & REPORTING)))
    return out


FEATURES = 7


def summary(found: list[tuple[int, int, int, float, int, bool]]) -> list[float]:
    """Of a text's hits: total and densest window of their scores, exact, near and quoted hits, best score."""
    if not found:
        return [0.0] * FEATURES
    score = [w * (1 - 0.35 * e) * (QUOTED if q else 1.0) for _, _, _, w, e, q in found]
    best, at = 0.0, 0
    for i in range(len(found)):
        while found[i][0] - found[at][0] > WINDOW:
            at += 1
        best = max(best, sum(score[at : i + 1]))
    free = [f for f in found if not f[5]]
    return [math.log1p(sum(score)), math.log1p(best), math.log1p(sum(f[4] == 0 for f in free)), math.log1p(sum(f[4] == 1 for f in free)), math.log1p(sum(f[4] == 2 for f in free)),
            math.log1p(len(found) - len(free)), max(score)]


def learn_lexicon(sample: DataFrame) -> tuple[Lexicon, int, int]:
    """Lexicon and numbers of other and toxic documents of a sample (text, label).  Words are counted in
    the toxic documents, and those that pass ``LEAST_DOCUMENTS`` in the others."""
    sizes = dict(sample.groupBy("label").count().collect())
    other, toxic = sizes.get(0, 0), sum(n for k, n in sizes.items() if k)
    if not other or not toxic:
        return Lexicon(), other, toxic

    def terms(text: str) -> set[tuple[str, bool]]:
        words = {w for w in _WORD(text.lower()) if 3 <= len(w) <= 40}
        return {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEM_LENGTHS if n < len(w)}

    def counter(known: set | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: Counter = Counter()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    total.update(terms(text) if known is None else terms(text) & known)
            if total:
                keys, counts = zip(*total.items())
                words, stems = zip(*keys)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(stems), pa.array(counts, pa.int64())], ["term", "stem", "n"])

        return run

    def counted(label, known=None):
        return sample.where(label).select("text").mapInArrow(counter(known), "term string, stem boolean, n long").groupBy("term", "stem").agg(F.sum("n").alias("n"))

    bad = {(t, s): n for t, s, n in counted(F.col("label") != 0).where(F.col("n") >= LEAST_DOCUMENTS).collect()}
    good = {(t, s): n for t, s, n in counted(F.col("label") == 0, set(bad)).collect()}
    odds = {k: math.log((n + 0.5) / (toxic + 1)) - math.log((good.get(k, 0) + 0.5) / (other + 1)) for k, n in bad.items()}
    strong = {k for k, x in odds.items() if x >= math.log(20) and good.get(k, 0) <= 0.02 * bad[k] * max(1, other / toxic)}
    # a stem must hold clearly more documents than each word and each longer stem that continues it
    words_by: dict[str, int] = {}
    for (t, s), n in bad.items():
        if (t, s) in strong:
            for m in STEM_LENGTHS:
                if m < len(t) or (m == len(t) and not s):
                    words_by[t[:m]] = max(words_by.get(t[:m], 0), n)
    stems = {t for t, s in strong if s and bad[t, True] >= 1.5 * words_by.get(t, 0)}
    stems = {t for t in stems if not any(t[:m] in stems for m in range(STEM_LENGTHS[0], len(t)))}
    chosen = {(t, True) for t in stems} | {(t, s) for t, s in strong if not s and not any(t[:m] in stems for m in STEM_LENGTHS if m <= len(t))}
    ranked = sorted(chosen, key=lambda k: (-odds[k] * math.log1p(bad[k]), k))[:MAX_ENTRIES]
    return Lexicon({k: odds[k] for k in ranked}), other, toxic


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled(docs, labels, label, rows).persist()
    try:
        lexicon, other, toxic = learn_lexicon(sample)
        share = toxic / max(1, other + toxic)
        if not lexicon.entries:
            return Model(lexicon, np.zeros(FEATURES), math.log((share + 1e-6) / (1 - share + 1e-6)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = Automaton(lexicon)
            for batch in batches:
                rows_ = [summary(hits(automaton, t)) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows_, pa.list_(pa.float64())), batch.column(1)], ["x", "label"])

        seen = sample.mapInArrow(run, "x array<double>, label int").groupBy("x", "label").count().collect()  # at most the sample's rows
    finally:
        sample.unpersist()
    seen.sort()
    x = np.array([r[0] for r in seen]).reshape(-1, FEATURES)
    y, n = np.array([r[1] != 0 for r in seen], float), np.array([r[2] for r in seen], float)
    scale = np.maximum(x.std(0), 1e-6)
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(FEATURES + 1)
    ridge = np.append(np.full(FEATURES, 1.0), 1e-6)
    for _ in range(60):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (n * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(lexicon, w[:-1] / scale, float(w[-1]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score, predicted, hits (number of matched words) and spans (their first and last
    code points with the text's words, weights and whether they are quoted) added."""
    added = ["score", "predicted", "hits", "spans"]
    rest = [c for c in docs.columns if c not in added]
    span = "array<struct<begin:int,end:int,weight:double,edits:int,quoted:boolean>>"
    schema = T.StructType([docs.schema[c] for c in rest] + T.StructType.fromDDL(f"score double, predicted int, hits int, spans {span}").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.lexicon)
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("weight", pa.float64()), ("edits", pa.int32()), ("quoted", pa.bool_())]))
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            found = [hits(automaton, t) for t in texts]
            x = np.array([summary(f) for f in found]).reshape(-1, FEATURES)
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights + model.bias, -30, 30)))
            spans = [[{"begin": b, "end": e, "weight": w, "edits": d, "quoted": q} for _, b, e, w, d, q in f] for f in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in rest), pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                                              pa.array([len(f) for f in found], pa.int32()), pa.array(spans, kind)], [*rest, *added])

    return docs.select(*rest).mapInArrow(run, schema)
