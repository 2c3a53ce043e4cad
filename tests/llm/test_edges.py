"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables, extra columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foldwise.llm import bpe, decontaminate, langid, linededup, quality, setjoin, simhash, toxicity, urls, warc
from foldwise.llm.tables import shared_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 5000}x the" for i in range(20000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away.\nshort line", "en", "a", 10), (1, "The quick brown fox jumps over the lazy dog and runs away.\nshort line", "en", "a", 10),
    (2, None, "en", None, None), (3, "", None, "b", 0), (4, " \n\t \n", "fr", "b", 5), (5, "!!! 123 ???", None, "b", 11), (6, LONG, "en", "c", len(LONG)),
    (7, "Le chat noir dort sur la table et la souris danse dans la nuit.", "fr", "c", 60), (None, "no key at all but some words to read here", None, None, None), (8, LONG + "tail", "en", "c", 1),
]
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(spark, request):
    rows = ROWS if request.param == "rows" else []
    clashing = ["score", "predicted", "lang_pred", "ids", "decoded", "hi", "lo", "n", "class", "component", "label", "at", "h", "key"]
    return spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("x").alias(c) for c in clashing))


def test_language(docs):
    n = docs.count()
    protos = langid.fit(docs)
    out = langid.predict(docs, protos)
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert out.count() == n and out.columns == [c for c in docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    if n:
        assert got[2] == got[3] == got[4] == got[5] == ("und", 0.0) and got[7][0] == "fr" and got[1][0] == "en"


def test_bpe(docs):
    out = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    given = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in out.collect():
        assert bytes(r.decoded) == given[r.doc_id]
    assert out.count() == docs.count()


def test_simhash(docs):
    out = simhash.with_next(simhash.simhash(docs), "doc_id", "text", ["hi", "lo"], simhash.swap_tail)
    assert out.count() == docs.count()
    for r in out.collect():
        if r.doc_id in (2, 3, 4):
            assert (r.hi, r.lo) == (0, 0)
    assert simhash.within(simhash.simhash(docs), simhash.simhash(docs), 3, 5).where("distance > 3").count() == 0


def test_setjoin(docs):
    got = {r.doc_id: r for r in setjoin.joined(docs).collect()}
    assert setjoin.joined(docs).count() == docs.count()
    if got:
        assert got[2].n == got[3].n == got[4].n == 0 and got[4].component == 4 and got[2].component == 2
        assert got[8].component == 6 and got[5].n == 1 and got[5].component == 5


def test_line_dedup(docs):
    out = linededup.dedup(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == docs.count() and set(docs.columns) < set(out.columns)
    if got:
        assert got[2].text is None and got[3].text == "" and got[4].text == " \n\t \n" and got[1].text == ROWS[0][1] and got[8].text == "" and got[6].text == LONG


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "the lazy dog and runs away short line"), (2, None), (3, "")], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.leaks(docs, items).collect()} == ({1} if docs.count() else set())
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items).columns == docs.columns


def test_classifiers(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    for out in (toxicity.score(docs, toxicity.fit(docs, labels)), quality.score(docs, quality.fit(docs, docs, labels)), toxicity.score(docs, toxicity.fit(docs, labels.limit(0)))):
        rows = out.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)


def test_pages(spark):
    schema = "page_id long, url string, html string, host string, rule string, payload string"
    rows = [(1, "http://a.net/x", "<p>hi</p>", "h", "r", "p"), (2, None, None, None, None, None), (3, "no scheme", "", "", "", ""), (3, "no scheme", "", "", "", ""), (None, "http://b.org", "<p>hi</p>", "", "", ""), (9, "HTTP://A.NET\n/x y", "é" * 100000, "", "", "")]
    for some in (rows, []):
        pages = spark.createDataFrame(some, schema)
        judged = urls.judge(pages, [("net/", "block")])
        assert judged.count() == len(some)
        read = warc.records(warc.write(pages, shared_folder(spark, "test")))
        assert read.count() == len(some) and read.where("not intact").count() == 0
        if some:
            got = {r.page_id: r for r in judged.collect()}
            assert got[1].verdict == "block" and got[2].host == got[3].host == "" and got[9].host == "a.net\n" and got[None].path == ""
            kinds = {(r.record_id, r.type) for r in read.collect()}
            assert ("<urn:x-page:2>", "response") in kinds and ("<urn:x-page:3>", "revisit") in kinds and ("<urn:x-page:9>", "response") in kinds


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, "the lazy dog and runs away short line")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "byte_bpe":
            assert out.columns == docs.columns, name
        out.collect()
