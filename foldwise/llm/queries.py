"""The whole-table queries of this package's operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm import bpe, collocations, decontaminate, exactdedup, langid, linededup, quality, setjoin, simhash, toxicity, trie, urls, warc
from foldwise.llm.oracles import COLLOCATIONS, EXACT_DEDUP, PREFIX_TRIE
from foldwise.llm.tables import held_out, keep, read, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read(spark, sf_dir, "documents").select("doc_id", "text"), held_out("doc_id")
    model = toxicity.fit(docs.where(~fold), read(spark, sf_dir, "labels").where(~fold).select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", fold.alias("held_out"), "score", "predicted", "hits")


@query("op2_warc_zip")
def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(read(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    found = warc.records(manifest, payload=False)
    return found.select(warc.page_key("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                        warc.page_key("refers_to").alias("refers_to"), "intact")


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.drop("_row")


@query("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.coalesce(F.size("_dropped"), F.lit(0)).alias("n_dropped"), F.col("_dropped").alias("dropped"), "text")


@query("op5_ngram_join")
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = setjoin.joined(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read(spark, sf_dir, "documents").select("doc_id", "text"), held_out("doc_id")
    net = quality.fit(docs, docs.where(~fold), read(spark, sf_dir, "labels").where(~fold).select("doc_id", "quality"))
    return quality.score(docs, net).select("doc_id", fold.alias("held_out"), "score", "predicted")


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, path, pattern), path, pattern)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    first = simhash.simhash(docs).withColumn("n", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    edited = simhash.with_next(first, "doc_id", "text", ["hi", "lo", "n"], simhash.swap_tail, docs)
    both = simhash.simhash(edited, "made", "e_hi", "e_lo").withColumn("edited_sha256", F.sha2("made", 256)).drop("made", "next_n")
    both = keep(both, "simhash")
    near = simhash.within(both, both.where(F.col("doc_id") % 100 == 0))
    near = near.groupBy("q_hi", "q_lo").agg(F.sum("rows").alias("n_within"))
    rows = both.join(near, (F.col("hi") == F.col("q_hi")) & (F.col("lo") == F.col("q_lo")) & (F.col("doc_id") % 100 == 0), "left")
    return rows.select("doc_id", F.col("n").alias("n_chars"), "edited_sha256",
                       simhash.fingerprint("hi", "lo").alias("fingerprint"), simhash.fingerprint("e_hi", "e_lo").alias("edited_fingerprint"),
                       simhash.likeness(simhash.distance("hi", "lo", "e_hi", "e_lo")).alias("near_edited"),
                       simhash.likeness(simhash.distance("hi", "lo", "next_hi", "next_lo")).alias("near_next"), "n_within")


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES).drop("alias")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = held_out("doc_id")
    prototypes = langid.fit(docs.where(~fold).select("text", "lang"))
    return langid.predict(docs.select("doc_id", "text"), prototypes).select("doc_id", fold.alias("held_out"), "lang_pred", "score")


@query("op11_collocations", COLLOCATIONS)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents").select("lang", "text"))


@query("op12_exact_dedup", EXACT_DEDUP)
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # half of the documents stand for the corpus so far, the other half arrives
    old = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = exactdedup.dedup(read(spark, sf_dir, "documents"), old)
    return out.select("doc_id", F.col("keep").alias("keep_id"), "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op13_prefix_trie", PREFIX_TRIE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(read(spark, sf_dir, "conversations")))
