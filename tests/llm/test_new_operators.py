"""Collocations, exact deduplication and the prefix trie against brute force, and their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import collocations, exactdedup, trie
from foldwise.llm.exactdedup import PerfectHash
from foldwise.llm.tables import join_hot, keep

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, extra string"


# ---------------------------------------------------------------- collocations
def test_workers_get_few_rows_and_shuffles_no_salt(spark, monkeypatch):
    """Texts are long rows: a batch of 10,000 fills a worker. What is worked out from a row isn't shuffled with it."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, words = spark.conf.get(key), collocations.vocabulary

    def watched(*given):
        known = words(*given)
        seen.append((spark.conf.get(key), known.columns))
        return known

    monkeypatch.setattr(collocations, "vocabulary", watched)
    docs = spark.createDataFrame([(i, "a b c a b", ["x", "y"][i % 2], "") for i in range(8)], DOCS)
    counts, _ = collocations.phrases(docs, least=8)
    assert seen == [(str(collocations.ROWS), ["lang", "h", "word", "last", "n"])] and spark.conf.get(key) == before
    # in both languages: 20 words, a and b 8 times, ab 8 times
    assert sorted((r["lang"], len(r["p"]), r["f"]) for r in counts.collect()) == [(x, *y) for x in "xy" for y in ((0, 20), (1, 8), (1, 8), (2, 8))]


def brute_collocations(rows, order, least, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, order + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, of in f.items():
        found = {p: a for p, a in of.items() if a >= least and len(p) > 1}
        inside = collections.Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        scored = []
        for p, a in found.items():
            score, k = min((1000 * a * n[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            if not inside[p] or 100 * inside[p] < 100 * a:
                scored.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def text_of(rnd, words):
    return "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", ""]) for _ in range(rnd.randint(0, 60)))


@pytest.mark.parametrize("seed", range(3))
def test_collocations_equal_brute_force(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(collocations, "COUNTED", 50)  # many small counts meet in Spark
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 700)
    words = ["A", "b", "the", "The", "of", "é", "ÉA", "日本", "x-y"] + [f"w{i}" for i in range(30)]
    rows = [(i, None if rnd.random() < 0.05 else text_of(rnd, words), rnd.choice(["en", "fr", None, "und"]), "x") for i in range(300)]
    rows += rows[:5] + [(999, "a b c d e f " * 40, "en", "x"), (1000, ".,;", "de", "x"), (1001, "", "de", "x")]
    df = spark.createDataFrame(rows, DOCS).select("*", *(F.lit(7).alias(c) for c in ("n", "f", "p", "h", "w1", "rank")))
    for order, least, top in ((5, 10, 2000), (3, 4, 7)):
        got = sorted(tuple(r) for r in collocations.collocations(df, order=order, least=least, top=top).collect())
        assert got == brute_collocations([(r[2], r[1]) for r in rows], order, least, top)


def test_collocations_take_another_seed_when_words_share_a_hash(spark, monkeypatch):
    real, seeds = collocations.vocabulary, []
    df = spark.createDataFrame([(1, "a b c a b " * 20, "en", "x")], DOCS)
    want = [tuple(r) for r in collocations.collocations(df, least=5).collect()]

    def clash(docs, seed, least):
        seeds.append(seed)
        known = real(docs, seed, least)
        return keep(known.withColumn("last", F.lit(b"zz")), "clash") if seed == 0 else known

    monkeypatch.setattr(collocations, "vocabulary", clash)
    assert [tuple(r) for r in collocations.collocations(df, least=5).collect()] == want and seeds == [0, 1]


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None), (2, " ", "en", None)], DOCS)).count() == 0


def test_tokens_read_whole_texts():
    texts = ["Ab, c", "", "d\te", "x", "\n", "f é\x0bg"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    words, piece = collocations.tokens(raw, offsets)
    assert [w.decode() for w in words.to_pylist()] == ["ab", "c", "d", "e", "x", "f", "é", "g"]
    same = piece[:-1] == piece[1:]
    assert same.tolist() == [False, False, True, False, False, True, False]


# ---------------------------------------------------------------- exact deduplication
@pytest.mark.parametrize("n", [0, 1, 2, 500, 20_000])
def test_perfect_hash_is_minimal_and_perfect(n):
    rnd = np.random.RandomState(n)
    known = rnd.randint(0, 256, (n, 32)).astype(np.uint8)
    made = PerfectHash.of(known)
    assert sorted(made.slots(known).tolist()) == list(range(n))


def test_perfect_hash_lists_what_all_levels_leave(monkeypatch):
    monkeypatch.setattr(exactdedup, "LEVELS", 1)
    known = np.random.RandomState(1).randint(0, 256, (300, 32)).astype(np.uint8)
    made = PerfectHash.of(known)
    assert made.rest and sorted(made.slots(known).tolist()) == list(range(300))
    other = np.random.RandomState(2).randint(0, 256, (50, 32)).astype(np.uint8)
    assert (made.slots(other) < 300).all()


def brute_dedup(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()].append((-len(t or ""), i is None, i))
    out = []
    for digest, of in groups.items():
        best = min(of)
        for x in of:
            out.append((x[2], best[2], len(of), digest))
    return sorted(out, key=str), sorted((d, min(of)[2]) for d, of in groups.items())


@pytest.mark.parametrize("history", ["doc_id % 2 = 0", "true", "false", "doc_id < 20"])
def test_exact_dedup_equals_brute_force(spark, history, monkeypatch):
    rnd = random.Random(5)
    monkeypatch.setattr(exactdedup, "COMBINED", 7)
    texts = ["a b", "ab", " a\tb\n", "A b", "", None, " \x0b", "é", "日 本", "日本", "x y", "xy", "long " * 5000]
    rows = [(i, rnd.choice(texts)) for i in range(120)] + [(i, "hot") for i in range(500, 560)] + [(None, "ab"), (None, "only"), (3, "ab"), (3, "ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit("x").alias(c) for c in ("id", "n", "c", "row", "keep", "digest", "bucket", "first", "_old")))
    got = exactdedup.dedup(df, F.expr(history), bucket=4).collect()
    want, kept = brute_dedup(rows)
    assert sorted(((r.doc_id, r["keep"], r.group_size, bytes(r.digest).hex()) for r in got), key=str) == want
    assert sorted((bytes(r.digest).hex(), r.doc_id) for r in got if r.kept) == kept  # one row of each group


def test_lookup_compares_whole_digests(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    new = spark.createDataFrame([(3, "a"), (4, "c"), (5, " a ")], "doc_id long, text string")
    index = exactdedup.build(exactdedup.digests(old))
    found = exactdedup.lookup(exactdedup.digests(new), index)
    assert {r.id: r.slot is not None for r in found.collect()} in ({3: True, 4: False}, {5: True, 4: False}, {3: True, 4: False, 5: True})
    assert exactdedup.lookup(exactdedup.digests(new), exactdedup.build(exactdedup.digests(old.limit(0)))).where("slot is not null").count() == 0
    assert exactdedup.dedup(old.limit(0), F.lit(True)).count() == 0


def test_join_hot_gives_every_row_its_match(spark):
    big = spark.createDataFrame([("h",)] * 3000 + [(f"k{i}",) for i in range(2000)] + [(None,)], "k string")
    small = spark.createDataFrame([("h", 3000, 1)] + [(f"k{i}", 1, 2) for i in range(1500)], "k string, w long, v int")
    got = collections.Counter(r.v for r in join_hot(big, small, "k", "w").collect())
    assert got == {1: 3000, 2: 1500, None: 501}


# ---------------------------------------------------------------- prefix trie
def brute_trie(rows):
    conv = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            conv[c].append(((t is not None, t or 0, key), (role, text)))
    conv = {c: [y for _, y in sorted(v)] for c, v in conv.items()}
    rebuilt = {}
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(conv.get(c - c % 5, [])[:h] + v[h:])
    members, kids = collections.defaultdict(list), collections.defaultdict(set)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[x] for x in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if len(rebuilt[c]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_trie_equals_brute_force(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(trie, "TURNS", rnd.choice([3, 12, 200_000]))  # blocks smaller than a partition
    rows = []
    for c in range(rnd.choice([40, 250])):
        if rnd.random() < 0.9:
            long = rnd.random() < 0.03
            rows += [(c, t if rnd.random() < 0.95 else None, rnd.choice(["u", None, "a"]) if long else "u", rnd.choice(["a", "a", "a", "bé", None])) for t in range(60 if long else rnd.randint(1, 9))]
    rows += rows[:3] + [(None, 1, "u", "lost")] + [(c, 0, "u", "same") for c in range(1000, 1080)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *(F.lit("x").alias(c) for c in ("key", "size", "depth", "id", "turns", "base")))
    for turns, fan in ((5, 2), (30, 64)):
        got = sorted((tuple(r) for r in trie.trie(trie.rebuilt(df), turns=turns, fan=fan).collect()), key=str)
        assert got == brute_trie(rows)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.trie(trie.rebuilt(empty)).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    got = [tuple(r) for r in trie.trie(trie.rebuilt(spark.createDataFrame([(c, 0, "u", "x")], "conv_id long, turn long, role string, text string"))).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
