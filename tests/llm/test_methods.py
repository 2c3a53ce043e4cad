"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import collections
import hashlib
import io
import itertools
import json
import random
import re
import subprocess
import sys
import zipfile

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from foldwise.llm import bpe, components, decontaminate, langid, linededup, queries, setjoin, simhash, toxicity, urls, warc
from foldwise.llm.tables import read, shared_folder

SF = "/root/testdata/sf0.001"


def texts(spark):
    return {r.doc_id: r.text or "" for r in read(spark, SF, "documents").select("doc_id", "text").collect()}


def test_bpe_equals_merging_by_rank(spark):
    path = public_tokenizers.path(queries.VOCABULARY)
    ranks = bpe.load_ranks(path)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    given = texts(spark)
    for r in queries.op7_byte_bpe(spark, SF).collect():
        ids = theirs.encode_ordinary(given[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(given[r.doc_id].encode()).hexdigest()
    own, rnd = bpe.encoder(path, public_tokenizers.PATTERN), random.Random(3)
    for i in range(3000):
        s = "".join(rnd.choice("ab é\n") if i % 3 == 0 else chr(rnd.randint(1, 0x2FFF)) if i % 3 == 1 else rnd.choice("😀 \x1c 't1") for _ in range(rnd.randint(1, 40)))
        assert own.encode(s).tolist() == theirs.encode_ordinary(s)


def shingle_sets(given):
    out = {}
    for i, t in given.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar(sets):
    ids = sorted(sets)
    return [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]


def test_setjoin_equals_all_pairs(spark):
    sets = shingle_sets(texts(spark))
    want = brute_components(sets, similar(sets))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_ngram_join(spark, SF).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_setjoin_chains_clouds_and_every_boundary(spark, monkeypatch):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    given, n = {}, 0
    for size in (3, 5, 8, 12, 20, 60, 120):
        base = [rnd.choice(words) for _ in range(size)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, size // 20))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            given[n] = " ".join(copy[: len(copy) - rnd.randint(0, 2)])
            n += 1
    sets = shingle_sets(given)
    want = brute_components(sets, similar(sets))
    docs = spark.createDataFrame([*given.items()], "doc_id long, text string")
    for boundary in (0, 16, 64):
        monkeypatch.setattr(setjoin, "boundary", lambda *a, b=boundary: b)
        got = {r.doc_id: r.component for r in setjoin.joined(docs).collect()}
        assert got == want, boundary


def test_boundary_follows_the_cost():
    assert setjoin.boundary({10: 100}, 0.0) in setjoin.BOUNDARIES
    assert setjoin.boundary({6: 100, 500: 100}, 1000.0) > 0  # long lists make subsets pay
    assert setjoin.boundary({200: 100}, 0.1) == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(40)] + [(7, 7), (None, 3), (5, None)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == brute_components({x for e in real for x in e}, real)


def test_line_dedup_finds_similar_lines(spark):
    """Components of the pairs that are similar by brute force; banding may miss few of them."""
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghijk") for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    lines = []
    for _ in range(60):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 50))]
        for _ in range(6):
            copy = list(base)
            if rnd.random() < 0.7:
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            lines.append("  ".join(copy).upper() if rnd.random() < 0.2 else " ".join(copy))
    docs = {i: "\n".join(lines[i * 4 : i * 4 + 4]) for i in range(len(lines) // 4)}
    got = {r.doc_id: r.text for r in linededup.dedup(spark.createDataFrame([*docs.items()], "doc_id long, text string")).collect()}

    def grams(line):
        line = " ".join(line.lower().split())
        return {line[i : i + linededup.SHINGLE] for i in range(max(1, len(line) - linededup.SHINGLE + 1))}

    sets = {i: grams(x) for i, x in enumerate(lines)}
    ids = sorted(sets)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])]
    want = brute_components(sets, linked)
    kept = [x for t in got.values() for x in t.split("\n") if x]
    least = len(set(want.values()))
    assert least <= len(kept) <= least + 0.02 * len(lines)
    assert set(kept) <= set(lines)
    # both ways: components are those of brute force, but for few pairs that share no key
    df = spark.createDataFrame([*enumerate(lines)], "doc_id long, text string")
    found = dict(linededup.similar(df, linededup.occurrences(df, "doc_id", "text"))[1].collect())
    ids = {r.n: r.id for r in df.select(F.col("doc_id").alias("n"), F.xxhash64(F.trim(linededup.normal(F.col("text")))).alias("id")).collect()}
    together = sum(found.get(ids[a], ids[a]) == found.get(ids[b], ids[b]) for a, b in linked)
    assert together >= 0.97 * len(linked)
    assert all(want[a] == want[b] for a in ids for b in ids if a < b and found.get(ids[a], ids[a]) == found.get(ids[b], ids[b]))


def test_line_dedup_of_repeated_ids_and_clashing_names(spark):
    shared, own = "a line that two documents share word for word", "a line of the second document and of no other one"
    rows = [(1, f"{shared}\nanother line that stands here alone", 1), (1, f"{shared}\n{own}", 2), (None, shared, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row long").select("*", *(F.lit("x").alias(c) for c in ("row", "key", "at", "line", "id", "m0", "first", "owner")))
    out = linededup.dedup(df).collect()
    assert sum(shared in r.text.split("\n") for r in out) == 1 and {r._row for r in out} == {1, 2, 3} and all(r.row == "x" for r in out)
    assert linededup.dedup(df.withColumn("_lines", F.lit(9)), lines="n_lines").columns == [*df.columns, "_lines", "n_lines", "_dropped"]
    twice = spark.createDataFrame([(5, shared), (5, shared)], "doc_id long, text string")  # one document, given twice
    assert [r.text for r in linededup.dedup(twice).collect()] == [shared, shared]


def test_runs_of_ascii_and_other_lines_agree(spark):
    df = spark.createDataFrame([("the quick brown fox",), ("the quick brown fox é",), ("short",), ("漢字" * 8,)], "s string")
    a, b, c, d = (set(r[0]) for r in df.select(linededup.runs(F.col("s"))).collect())
    assert a < b and (len(a), len(b), len(c), len(d)) == (10, 12, 1, 2)


def test_plane_has_every_pair_of_bins_once():
    pairs = collections.Counter(p for line in linededup._plane() for p in itertools.combinations(sorted(line), 2))
    assert len(pairs) == 120 and set(pairs.values()) == {1}


def test_decontamination_catches_new_parameters(spark):
    item = "A train leaves Paris and travels 120 km in 2 hours while another train leaves Lyon and travels 90 km in 3 hours so how far apart are the two trains from Paris"
    changed = item.replace("Paris", "Berlin").replace("Lyon", "Hamburg").replace("120", "455").replace("90", "81.5").replace(" 2 ", " 7 ")
    broken = item.replace("from Paris", "from Rome")  # one name of the item has two here
    other = "A completely different sentence about cooking rice with 120 grams of salt and 3 spoons of oil in a pan for Anna and her friends"
    docs = spark.createDataFrame([(1, f"Intro words here. {item} More words follow."), (2, f"We wrote: {changed}. The end."), (3, f"Look, {broken}"), (4, other), (5, item.upper())], "doc_id long, text string")
    got = {r.doc_id: (r.slots, r.changed) for r in decontaminate.leaks(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert set(got) >= {1, 2} and 3 not in got and 4 not in got
    assert got[1][1] == 0 and got[2][1] >= 4


def test_decontamination_equals_brute_force(spark):
    """Items are plain prose here: a leak is a passage with half of the item's windows."""
    def words(t):
        return re.findall(r"[^\W\d_]+", t.lower())

    items = {r.item_id: words(r.text) for r in read(spark, SF, "benchmark").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, SF).collect()}
    want = set()
    for i, t in texts(spark).items():
        w = words(t)
        runs = collections.defaultdict(list)
        for k in range(len(w) - 7):
            runs[tuple(w[k : k + 8])].append(k)
        for j, x in items.items():
            spots = collections.Counter(q - p for p in range(len(x) - 7) for q in runs.get(tuple(x[p : p + 8]), []))
            if spots and max(spots.values()) >= 0.8 * (len(x) - 7):
                want.add((i, j))
    assert want and want <= got
    assert all(len(set(items[j]) & set(words(texts(spark)[i]))) >= 0.5 * len(set(items[j])) for i, j in got)


def test_simhash_votes_are_counted_in_bytes():
    """Bits are summed as bytes: groups beyond 255 terms of one weight, repeated terms, and no float for every bit of a term."""
    import tracemalloc

    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(m)}" for _ in range(n)) for n, m in ((40_000, 10**9), (5000, 40), (700, 9), (256, 10**9), (2, 5), (1, 5))] + [""]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    simhash.sketch(data, offsets)  # powers of the word hash are made once
    tracemalloc.start()
    got = simhash.sketch(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000 * simhash.BITS * 4
    runs, doc = simhash.shingles(*simhash.words(data, offsets), len(texts), 2)
    for i in range(len(texts)):
        votes = np.zeros(simhash.BITS)
        for h, times in collections.Counter(runs[doc == i].tolist()).items():
            term = np.array([h], np.uint64)
            both = np.concatenate([term, simhash.mix(term * simhash._SECOND)])
            votes += (1 + np.log(times)) * (2.0 * np.unpackbits(both.view(np.uint8)) - 1)
        assert got[i].tolist() == np.packbits(votes > 1e-4).view(np.int64).tolist()


def test_simhash_edits_and_search(spark):
    given = sorted(texts(spark).items())
    prints = {}
    for r in queries.op8_simhash(spark, SF).collect():
        k = [i for i, _ in given].index(r.doc_id)
        t, u = given[k][1], given[(k + 1) % len(given)][1]
        edited = t[: len(t) - len(t) // 4] + u[: len(t) // 4]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints[r.doc_id] = (r.fingerprint, r.edited_fingerprint, edited, r)
    by_text = collections.defaultdict(set)
    for i, t in given:
        by_text[t].add(prints[i][0])
    for i, (_, e, edited, _) in prints.items():
        by_text[edited].add(e)
    assert all(len(v) == 1 for v in by_text.values())
    rows = [p[3] for p in prints.values() if len(p[2]) > 400]
    assert np.mean([r.near_edited for r in rows]) > 0.6 > 0.3 > np.mean([r.near_next for r in rows])
    rnd = random.Random(4)
    data = [(rnd.getrandbits(63), rnd.getrandbits(63)) for _ in range(50)]
    data += [(h ^ 1 << rnd.randrange(62), lo ^ 1 << rnd.randrange(62)) for h, lo in data] + data[:5]
    found = {(r.q_hi, r.q_lo, r.hi, r.lo): (r.distance, r.rows) for r in simhash.within(spark.createDataFrame(data, "hi long, lo long"), spark.createDataFrame(data[:20], "hi long, lo long"), 2, 4).collect()}
    want = {(*q, *p): (bin(q[0] ^ p[0]).count("1") + bin(q[1] ^ p[1]).count("1"), data.count(p)) for q in data[:20] for p in data}
    assert found == {k: v for k, v in want.items() if v[0] <= 2}


def test_toxicity_automaton_equals_edit_distance():
    lexicon = toxicity.Lexicon({("idiot", False): 2.0, ("worthless", False): 3.0, ("cad", False): 1.0, ("lostra", True): 2.5})
    automaton = toxicity.Automaton(lexicon)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            old, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                old, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, old + (x != y))
        return row[-1]

    rnd = random.Random(1)
    for _ in range(4000):
        word = list(rnd.choice([k[0] for k in lexicon.entries]))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(word) + 1)
            word[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "t", "x", "1"])
        word = "".join(word)
        allowed = []
        for (e, stem), _w in lexicon.entries.items():
            d = min((distance(word[:n], e) for n in range(len(word) + 1)), default=9) if stem else distance(word, e)
            if d <= toxicity.edits_allowed(e, stem):
                allowed.append(d)
        got = automaton.match(word)
        assert (got[1] if got else None) == (min(allowed) if allowed else None), word


def test_toxicity_spares_quotations():
    automaton = toxicity.Automaton(toxicity.Lexicon({("idiot", False): 3.0}))
    plain, quoted = (toxicity.summary(toxicity.hits(automaton, t)) for t in ("you are an idiot and a fool", 'the word "idiot" is an insult'))
    assert plain[0] > quoted[0] > 0


def accuracy(spark, rows, label, sf):
    labels = {r.doc_id: r[label] for r in read(spark, sf, "labels").collect()}
    seen = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    ones, zeros = [s for s, y in seen if y], [s for s, y in seen if not y]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    assert accuracy(spark, queries.op1_toxicity(spark, sf).collect(), "toxic", sf) > 0.95
    assert accuracy(spark, queries.op6_quality(spark, sf).collect(), "quality", sf) > 0.98
    langs = {r.doc_id: r.lang for r in read(spark, sf, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op10_language_id(spark, sf).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) > 0.98 * len(rows)


def test_urls(spark):
    html = '<html><head><link rel="canonical" href="{}"></head></html>'
    refresh = "<meta http-equiv='refresh' content='0; url={}'>"
    pages = [
        (1, "http://spam.net/a", ""), (2, "https://ok.org/b", html.format("http://spam.net/a")), (3, "http://ok.org/c?x=1", refresh.format("/b")), (4, "http://ok.org/d", html.format("e")),
        (5, "http://Sub.Example.NET/en/q", html.format("http://z.com/y")), (6, "http://z.com/y#top", ""), (7, "http://z.com/w", html.format("//spam.net/zz")), (8, "http://z.com/y", html.format("http://spam.net/a")), (9, "http://example.net", None),
    ]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), queries.URL_RULES).collect()}
    assert got[1] == ("spam.net", "/a", "net/", "block") and got[2] == ("ok.org", "/b", None, "allow") and got[3][3] == "allow"  # joined to 5 through 8 and 6, which is allowed
    assert got[4][3] == "allow" and got[5] == ("sub.example.net", "/en/q", "example.net/en/", "allow") and got[7] == ("z.com", "/w", None, "block")
    assert got[9] == ("example.net", "", None, "allow")


def test_warc_round_trip_and_foreign_packages(spark, tmp_path):
    got = {r.page_id: r for r in queries.op2_warc_zip(spark, SF).collect()}
    pages = {r.page_id: (r.html or "").encode() for r in read(spark, SF, "pages").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    for i, data in pages.items():
        r = got[i]
        assert (r.payload_bytes, r.payload_digest, r.intact) == (len(data), warc.digest(data), True)
        assert (r.record_type, r.refers_to) == (("response", None) if first[data] == i else ("revisit", first[data]))
    # a member without index, a plain WARC, ZIP64 fields and a comment behind the directory
    record = warc.record(5, "http://x/y", b"payload", None)
    path = tmp_path / "own.wacz"
    with zipfile.ZipFile(path, "w") as z:
        with z.open(zipfile.ZipInfo("archive/a.warc.gz"), "w", force_zip64=True) as m:
            m.write(record * 3)
        import gzip
        z.writestr(zipfile.ZipInfo("archive/b.warc"), gzip.decompress(record) * 2)
        z.writestr(zipfile.ZipInfo("archive/c.warc.gz"), b"junk" + record)
        z.writestr(zipfile.ZipInfo("indexes/index.cdxj"), "com,x)/y 2024 " + json.dumps({"filename": "archive/c.warc.gz", "offset": "4", "length": str(len(record))}))
        z.comment = b"PK\x05 a comment"
    rows = warc.records(spark.createDataFrame([(str(path),)], "path string")).collect()
    assert [bytes(r.payload) for r in rows] == [b"payload"] * 6 and all(r.intact for r in rows)


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr(zipfile.ZipInfo("a"), b"x" * 50)
        z.writestr(zipfile.ZipInfo("b"), b"y" * 60)
    assert b"PK\x06\x07" in data.getvalue()
    found = warc.directory(data, len(data.getvalue()))
    assert [(n, data.getvalue()[b : b + k]) for n, b, k in found] == [("a", b"x" * 50), ("b", b"y" * 60)]


def test_folds(spark):
    import zlib

    from foldwise.llm.tables import held_out

    rows = spark.range(-20, 200).select(F.col("id"), held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_line_shingles_of_scripts_without_blanks(spark):
    rows = spark.createDataFrame([("ab cde",), ("é ab",), ("漢字 ab",), ("x",)], "s string").select(linededup.shingles(F.col("s"), 3)).collect()
    assert [r[0] for r in rows] == [["ab ", "cde"], ["é a", "ab"], ["漢字 ", "字 a", "ab"], ["x"]]


def test_line_dedup_decides_all_members_of_a_group(spark):
    """Families of near copies under one template, which share key groups: unlike one another, alike within."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefghijk") for _ in range(6)) for _ in range(2000)]
    template, lines = [rnd.choice(words) for _ in range(40)], []
    for _ in range(120):
        own = template + [rnd.choice(words) for _ in range(9)]
        lines += [" ".join(own), " ".join(own[:-1] + [rnd.choice(words)])]
    docs = spark.createDataFrame([*enumerate(lines)], "doc_id long, text string")
    each = linededup.occurrences(docs, "doc_id", "text")
    _, groups = linededup.similar(docs, each)
    found = dict(groups.collect())
    ids = [r[0] for r in spark.createDataFrame([*enumerate(lines)], "n long, s string").orderBy("n").select(F.xxhash64("s")).collect()]
    families = [(found.get(a, a), found.get(b, b)) for a, b in zip(ids[::2], ids[1::2])]
    assert all(a == b for a, b in families) and len(set(families)) == 120


def test_line_dedup_compares_all_characters(spark):
    lines = ["https://www.example.org/a/long/path-1", "https://www.other.net/zzz", "q" * 10 + "abcdefghijklmnop", "q" * 10 + "ABCDEFGHIJ!LMNOP"]
    lines += [f"{word}nationalisation{i % 2} of undertakings" for word in ("de", "re") for i in range(2)] + ["x" * 60 + " end", "x" * 60 + " end."]
    docs = spark.createDataFrame([*enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup(docs).collect()}
    grams = [{x.lower()[i : i + 10] for i in range(max(1, len(x) - 9))} for x in lines]
    linked = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if len(grams[a] & grams[b]) >= 0.75 * len(grams[a] | grams[b])]
    want = brute_components(range(len(lines)), linked)
    assert {i for i, x in got.items() if x} == set(want.values())


def test_decontamination_slots_of_the_passage_and_of_every_diagonal(spark):
    item = "A train leaves Paris and travels 120 km in 2 hours while another train leaves Lyon and travels 90 km in 3 hours so how far apart are the two trains from Paris"
    tail = item.replace("so how far apart are the two trains from Paris", "then we all went home and nobody saw from Rome")
    broken = item.replace("from Paris", "from Rome")
    docs = spark.createDataFrame([(1, tail), (2, f"{broken}. {item}"), (2, f"{broken}. {item}"), (3, broken)], "doc_id long, text string")
    got = [(r.doc_id, r.at > 0) for r in decontaminate.leaks(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()]
    assert sorted(got) == [(1, False), (2, True), (2, True)]


def test_language_bundles_of_many_different_trigrams_are_small():
    """4,000 short texts over a large alphabet: the same bundles as one dense product, in blocks."""
    rnd = random.Random(3)
    texts = ["".join(chr(rnd.randint(0x4E00, 0x9FA5)) for _ in range(rnd.randint(0, 12))) for _ in range(200)] + ["the end", ""]
    codes, owner = langid.trigrams(texts)
    want = np.zeros((len(texts), langid.DIMENSIONS), np.float32)
    np.add.at(want, owner, langid.bound(codes))
    assert (langid.bundles(texts, np.arange(len(texts)), len(texts)) == want).all()
    code = ("import resource, random, numpy as np\nfrom foldwise.llm import langid\nrnd = random.Random(1)\n"
            "texts = [''.join(chr(rnd.randint(0x4E00, 0x9FA5)) for _ in range(40)) for _ in range(2000)]\n"
            "for low in range(0, 2000, langid.TEXTS): langid.bundles(texts[low:low + langid.TEXTS], np.arange(len(texts[low:low + langid.TEXTS])), langid.TEXTS)\n"
            "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)")
    used = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert used < 500


def test_language_stage_drops_unknown_scripts_and_keeps_clean_documents(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rnd = random.Random(7)
    scripts = [(0x0400, 0x044F), (0x05D0, 0x05EA), (0x0905, 0x0939), (0x3041, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]
    strange = [(10**6 + i, " ".join("".join(chr(rnd.randint(*scripts[i % 6])) for _ in range(rnd.randint(2, 8))) for _ in range(30)), None, "x", 1) for i in range(300)]
    both = docs.unionByName(spark.createDataFrame(strange, docs.schema)).withColumn("_lang", F.lit("mine")).withColumn("_score", F.lit(1))
    out = corpus_pipeline.language_id(spark, both, "")
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert out.columns == both.columns and {r._lang for r in out.select("_lang").distinct().collect()} == {"mine"}
    lettered = {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert len([i for i in kept if i >= 10**6]) <= 1
    assert not lettered - kept
