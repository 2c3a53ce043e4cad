"""The pipeline as a whole on planted cases, and its stages one after another against brute force."""

import random
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from foldwise.llm import bpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SHARED = "all rights reserved by the owners of this site and of everything that is shown on it"


def words(rnd, n, alphabet="abcdefghijklmnoprstuvw"):
    return [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(3, 8)))) for _ in range(n)]


def corpus():
    rnd = random.Random(12)
    item = " ".join(words(rnd, 40))
    rows = []
    for i in range(30):
        lines = [" ".join(words(rnd, 25)) for _ in range(4)]
        if i in (3, 7, 11):
            lines.insert(2, SHARED)
        rows.append([i, "\n".join(lines), "en"])
    one_line = " ".join(words(rnd, 120))
    near = one_line.split(" ")
    near[60] = "changedword"
    # copies of a one-line document are lost with their line, near copies of lines likewise
    rows += [[100, one_line, "en"], [101, one_line, "en"], [102, " ".join(near), "en"]]
    rows += [[200, " ".join(words(rnd, 30)) + "\n" + item + "\n" + " ".join(words(rnd, 30)), "en"]]
    rows += [[300, " ".join(words(rnd, 40, "абвгдежзиклмнопрстуфх")), None], [301, None, "en"], [302, "12 34 !!", "en"], [303, "", None]]
    # lines differ in part (below 0.75), shingles of the whole documents don't: the n-gram join's case
    body = [words(rnd, 60) for _ in range(6)]
    a, b = [list(x) for x in body], [list(x) for x in body]
    b = [x[30:] + y[:30] for x, y in zip(b, b[1:] + b[:1])]
    rows += [[400, "\n".join(" ".join(x) for x in a), "en"], [401, "\n".join(" ".join(x) for x in b), "en"]]
    return [(i, t, lang, "s", len(t or "")) for i, t, lang in rows], item


def test_planted_cases(spark, tmp_path):
    rows, item = corpus()
    spark.createDataFrame(rows, DOCS).withColumn("_row", F.lit(1)).withColumn("_dropped", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = set(range(30))
    assert clean <= set(out), clean - set(out)  # every clean document stays
    assert not {101, 102, 200, 300, 301, 302, 303} & set(out) and 100 in out and 400 in out and 401 not in out
    assert all(r.round_trip for r in out.values())
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)), special_tokens={})
    given = {r[0]: r[1] for r in rows}
    texts = {i: theirs.decode(r.ids) for i, r in out.items()}
    assert [i for i, t in texts.items() if SHARED in t] == [3]  # the smallest document keeps the line
    for i in clean - {7, 11}:
        assert texts[i] == given[i] and out[i].n_tokens == len(theirs.encode_ordinary(given[i])) and out[i].n_chars == len(given[i])
    for i in (7, 11):
        assert texts[i] == given[i].replace(SHARED + "\n", "")


def test_ngram_stage_keeps_one_document_of_each_component(spark):
    rnd = random.Random(4)
    base = [words(rnd, 40) for _ in range(12)]
    rows = []
    for i in range(60):
        w = list(base[i % 12])
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(40)] = "".join(words(rnd, 1))
        rows.append((i, " ".join(w), "en", "s", 1))
    sets = {r[0]: {tuple(x[k : k + 5]) for x in [re.findall(r"\S+", r[1])] for k in range(len(x) - 4)} for r in rows}
    low = {i: i for i in sets}
    moved = True
    while moved:
        moved = False
        for a in sets:
            for b in sets:
                if low[b] < low[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low[a], moved = low[b], True
    got = {r.doc_id for r in corpus_pipeline.ngram_join(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert got == set(low.values())


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
